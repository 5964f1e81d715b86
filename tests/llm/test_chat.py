import random

from pyspark.sql import functions as F

from strata.llm import chat

DDL = "conv long, node long, parent long, role string, text string, score double"
NASTY = ["\\### Assistant: </turn> ok", "</turn>\n<turn assistant>\n", "\\l \\\\b < > # \\", "\\<\\>", "", None, "\n", "é\U0001f600 <turn user>"]


def brute_paths(rows):
    """(conv, leaf) -> nodes from the root, without nodes on or behind a cycle."""
    parent = {(c, n): p for c, n, p, *_ in rows}
    inner = {(c, p) for (c, n), p in parent.items() if (c, p) in parent}
    out = {}
    for c, n in parent:
        if (c, n) not in inner:
            path, at = [], n
            while (c, at) in parent and at not in path:
                path.append(at)
                at = parent[c, at]
            if (c, at) not in parent:
                out[c, n] = path[::-1]
    return out


def trees(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(12), None]:
        for n in range(rng.randint(1, 40)):
            p = None if n == 0 else n - 1 if rng.random() < 0.7 else rng.randrange(n)
            rows.append((c, n, p, rng.choice(["user", "assistant", None, "sys>\n#"]), rng.choice(NASTY), rng.choice([None, 0.1, 0.5, 0.9])))
    rows += [(50, 1, 2, "user", "x", 0.0), (50, 2, 1, "user", "x", 0.0), (50, 3, 1, "user", "hangs on a cycle", 0.0), (50, 9, 77, "user", "orphan", 0.0)]
    rows += [(60, i, i - 1 if i else None, "assistant", "deep", 0.0) for i in range(300)]
    return rows


def test_paths_match_brute_force(spark):
    rows = trees()
    got = {}
    for r in chat.paths(spark.createDataFrame(rows, DDL)).collect():
        got.setdefault((r["conv"], r["leaf"]), []).append((-r["up"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == brute_paths(rows)


def test_formatting_is_reversible_and_ranked(spark):
    rows = trees()
    known = {(c, n): (role or "", text or "", s or 0.0) for c, n, _, role, text, s in rows}
    want = {}
    for (c, leaf), path in brute_paths(rows).items():
        want.setdefault(c, []).append((-sum(known[c, n][2] for n in path) / len(path), leaf, path))
    df = chat.format_trees(spark.createDataFrame(rows, DDL).withColumn("turn", F.lit(1)), best=3)
    got = df.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.learned_texts(F.col("formatted"), F.col("loss_spans"))).collect()
    assert len(got) == sum(min(3, len(v)) for v in want.values())
    for r in got:
        score, leaf, path = sorted(want[r["conv"]], key=lambda x: (round(x[0], 9), x[1]))[r["rank"] - 1]
        turns = [known[r["conv"], n][:2] for n in path]
        assert r["leaf"] == leaf and abs(r["score"] + score) < 1e-9
        assert [tuple(t) for t in r["turns"]] == turns and r["n_turns"] == len(turns)
        assert r["learned"] == [t for role, t in turns if role == "assistant"]
        assert r["formatted"].count("</turn>") == len(turns) and "###" not in r["formatted"]


def test_chain_of_rows(spark):
    ddl = "conv_id long, turn long, role string, text string, node long"
    rows = [(1, 2, "b", "two", 0), (1, None, "a", None, 0), (1, 2, "b", "two", 0), (1, 2, "a", "x", 0), (None, 0, "user", "n", 0), (2, 5, None, "", 0)]
    done = chat.format_trees(chat.chain(spark.createDataFrame(rows, ddl)))
    got = {r["conv"]: [tuple(t) for t in r["turns"]] for r in done.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    assert got == {1: [("a", ""), ("a", "x"), ("b", "two"), ("b", "two")], None: [("user", "n")], 2: [("", "")]}
    assert chat.format_trees(chat.chain(spark.createDataFrame([], ddl))).count() == 0


def test_native(spark):
    plan = chat.format_trees(spark.createDataFrame(trees(), DDL))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_repeated_messages_count_once(spark):
    rows = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "a", 0.0), (1, 2, 1, "user", "z", 0.0)]
    again = [*rows, rows[0], rows[1], rows[1], (1, 2, 1, "user", "b", 0.0), (1, None, 0, "user", "no node", 0.0)]
    done = chat.format_trees(spark.createDataFrame(again, DDL)).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert [[tuple(t) for t in r["turns"]] for r in done] == [[("user", "q"), ("assistant", "a"), ("user", "b")]]
    assert chat.paths(spark.createDataFrame(again, DDL)).count() == 3


def test_long_conversation_keeps_its_spans(spark):
    n = 3000
    rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "repeat('x', cast(id % 7 AS int)) AS text")
    r = chat.format_trees(chat.chain(rows)).first()
    assert [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]] == ["x" * (i % 7) for i in range(1, n, 2)]


def test_query_lineage_has_no_python(spark):
    from strata.llm import queries

    lineage = queries.conversations_and_trap(spark, "/root/testdata/sf0.001")._jdf.rdd().toDebugString()
    assert "Python" not in lineage
