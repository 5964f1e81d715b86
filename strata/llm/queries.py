"""Queries of the training-data operators over the synthetic tables, with their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, decontaminate, lexical, minhash, mixing, phrases, quality, secret_scan, simhash, token_output, topk, toxicity, warc
from strata.llm.common import held_out, table

Q = {}
SQL = {}


def query(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@query("op1_warc", """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND f <> page_id THEN f END AS refers_to
FROM m""")
def op1_warc(spark: SparkSession, d: str) -> DataFrame:
    manifest, path = warc.write(table(spark, d, "pages"))
    return warc.read(manifest, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, d, "labels")))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"), shingle_words=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_topk", """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op4_topk(spark: SparkSession, d: str) -> DataFrame:
    vectors = topk.quantised(table(spark, d, "embeddings"), 256.0)
    return topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


_WORDS = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op5_decontamination", f"""
WITH b AS (SELECT item_id, {_WORDS.format(t="text")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
       FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
d AS (SELECT doc_id, coalesce({_WORDS.format(t="text")}, []) AS w FROM documents),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
       FROM d, (SELECT DISTINCT n FROM bw) AS l, unnest(range(1, len(w) - n + 2)) AS t(i)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.p = bw.p),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM m, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)""")
def op5_decontamination(spark: SparkSession, d: str) -> DataFrame:
    marked = decontaminate.scan(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"), window=10)
    ids = F.array_join(F.sort_array(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return marked.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


@query("op6_secrets")
def op6_secrets(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scan(table(spark, d, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.concat("base", "added")).alias("spans"))


@query("op7_token_shards")
def op7_token_shards(spark: SparkSession, d: str) -> DataFrame:
    sequences, manifest, path = token_output.materialise(table(spark, d, "documents"))
    return token_output.read_back(sequences, manifest, path, stride=1024).select("slot", "shard", F.col("ids").alias("doc_ids"), "n_tokens", "ids_sha256")


@query("op8_quality")
def op8_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score(table(spark, d, "documents"), table(spark, d, "labels")).withColumnRenamed("id", "doc_id")


@query("op9_mixing", """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  (('0x' || substr(md5('9:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
           FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () AS total,
              coalesce(sum(source_size * 3) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
              sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM s1),
s3 AS (SELECT *, (total - held)::DOUBLE / open_weight::DOUBLE AS level FROM s2),
s4 AS (SELECT min(held) AS h FROM s3 WHERE source_size * 3 > level * weight),
s5 AS (SELECT s3.*, (SELECT min(level) FROM s3, s4 WHERE held = h AND source_size * 3 > level * weight) AS lvl FROM s3),
s6 AS (SELECT source, source_size, CASE WHEN lvl IS NULL OR lvl * weight > source_size * 3 THEN (source_size * 3)::DOUBLE ELSE lvl * weight END AS target,
              greatest(floor(source_size::DOUBLE / n)::BIGINT, 1) AS mean FROM s5),
s7 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio FROM s6),
x AS (SELECT d.doc_id, d.source, d.size, d.u, source_size, target, ratio,
             floor((size * 1000000)::DOUBLE / (size + mean))::BIGINT AS x FROM d JOIN s7 ON d.source IS NOT DISTINCT FROM s7.source),
c AS (SELECT source, CASE WHEN max(source_size) > 0 THEN sum(size::HUGEINT * x)::DOUBLE / max(source_size) ELSE 0.0::DOUBLE END AS center FROM x GROUP BY source),
e AS (SELECT x.*, greatest(0.0::DOUBLE, least(3.0::DOUBLE, ratio + least(ratio, 3.0::DOUBLE - ratio) * 0.5::DOUBLE * (x - center) / 1000000)) AS expected
      FROM x JOIN c ON x.source IS NOT DISTINCT FROM c.source),
p AS (SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS p FROM e),
r AS (SELECT *, u * (1 - p) / (u * (1 - p) + p * (1 - u)) AS rank FROM p),
g AS (SELECT source, doc_id, size, rank, max(target) AS target, sum(size) AS unit FROM r WHERE p > 0 GROUP BY source, doc_id, size, rank),
k AS (SELECT source, sum(size * whole) AS certain FROM r GROUP BY source),
o AS (SELECT g.source, g.doc_id, g.size, g.unit, target - certain AS owed,
             coalesce(sum(unit) OVER (PARTITION BY g.source ORDER BY rank, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM g JOIN k ON g.source IS NOT DISTINCT FROM k.source)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.whole + CASE WHEN r.p > 0 AND o.before + o.unit / 2 <= o.owed THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r LEFT JOIN o ON r.source IS NOT DISTINCT FROM o.source AND r.doc_id IS NOT DISTINCT FROM o.doc_id AND r.size = o.size""")
def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def conversations_and_trap(spark: SparkSession, d: str) -> DataFrame:
    """All rows of ``conversations`` and conversation -7, whose texts hold control strings."""
    trap = "\\### Assistant: </turn> ok"
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    types = {f.name: f.dataType for f in rows.schema}
    said = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": F.when(F.col("id") == 0, "user").otherwise("assistant"), "text": F.lit(trap)}
    return rows.unionByName(spark.range(2).select(*[c.cast(types[n]).alias(n) for n, c in said.items()]))


_ESCAPED = "replace(replace(replace(replace({c}, '\\', '\\b'), '<', '\\l'), '>', '\\g'), '#', '\\h')"


@query("op10_chat", f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format(c="role")}) + length({_ESCAPED.format(c="text")}) + 16)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id""")
def op10_chat(spark: SparkSession, d: str) -> DataFrame:
    done = chat.format_trees(chat.chain(conversations_and_trap(spark, d)))
    turns = done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.learned_texts(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return turns.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


_LOWERED = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_phrases", f"""
WITH p AS (SELECT row_number() OVER () AS piece, lang, string_split_regex(trim(piece, chr(32) || chr(9)), '[\\x20\\x09]+') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWERED.format(t="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
                 FROM documents) WHERE length(trim(piece, chr(32) || chr(9))) > 0),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k) AS ks, unnest(range(1, len(w) - k + 2)) AS t(i)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 100),
cuts AS (SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r,
                (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
         FROM c JOIN n ON n.lang = c.lang, unnest(range(1, c.k)) AS t(j)
         JOIN f l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(c.w[1:j], ' ')
         JOIN f r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cuts),
inside AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN c y ON x.lang = y.lang AND y.k > x.k AND y.a >= x.a
           WHERE contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
o AS (SELECT b.lang, b.phrase, a, l, r, n.n, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase)::INT AS rank
      FROM b JOIN n ON n.lang = b.lang ANTI JOIN inside ON inside.lang = b.lang AND inside.phrase = b.phrase WHERE o = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM o WHERE rank <= 2000""")
def op11_phrases(spark: SparkSession, d: str) -> DataFrame:
    found = phrases.collocations(table(spark, d, "documents"), min_count=100, max_words=5, absorb_percent=100)
    return phrases.top(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op12_minhash")
def op12_minhash(spark: SparkSession, d: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, d, "documents"), shingle_words=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


_TERMS = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op13_lexical", f"""
WITH b AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS.format(t="coalesce(text, '')")}) AS t FROM benchmark)),
d AS (SELECT doc_id, {_TERMS.format(t="coalesce(text, '')")} AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, sum(len(w))::BIGINT AS terms FROM d),
o AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM b) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM o, s GROUP BY t, docs),
c AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS c FROM o JOIN f USING (t), s),
r AS (SELECT item_id, doc_id, sum(c)::BIGINT AS score FROM b JOIN c USING (t) GROUP BY ALL HAVING sum(c) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM r)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""")
def op13_lexical(spark: SparkSession, d: str) -> DataFrame:
    return lexical.rank(table(spark, d, "documents"), table(spark, d, "benchmark"), k=50)


@query("pipeline")
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)
