"""Secret scans with a randomness test battery (DataFrame functions only).

Rules find assignments to secret-like names, access keys and hex runs. Beside
them every run of 20 or more characters of a base-64 alphabet is a candidate.
Its encoding is the smallest of decimal, hex, base 32, base 62 and base 64
that holds it, and three tests ask whether it is a random string over that
alphabet: chi-squared uniformity of its characters, the number of runs above
and below the middle of the alphabet, and the lag-1 serial correlation.
Natural words, dates and paths fail at least one; keys do not.

A candidate's p-value is three times the least of the three. Calling a string
not random is the discovery, and the share of false ones among the candidates
thus thrown away is held at ``rate``: p-values are weighted by length (longer
strings can be told apart better, so they are thrown away more readily) and
cut by the step-up rule over the distinct candidates of the whole corpus,
counted in cells of 1/100 decade. What is left is a finding.

Positions are code points, the end exclusive. They follow from the pieces
between the matches, so no text is searched per match.

Edge cases: null texts are empty; texts of any length are scanned whole; a
candidate inside a rule's span is not listed again; rows that repeat an id or
a text are scanned alike, and a string counts once in the cut however often
it occurs; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import let, running, staged

# fixed values: the rules
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = ("(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in n) for n in NAMES) + ")"
          + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]{12,}"  # 16 characters in all; a shorter key has no longer one inside
HEX = "[0-9a-f]{32,}"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGNED = 8

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (pattern of the whole string, its alphabet in order), smallest alphabet first
ENCODINGS = (("[0-9]+", DIGITS), ("[0-9a-f]+", DIGITS + "abcdef"), ("[0-9A-F]+", DIGITS + "ABCDEF"), ("[A-Z2-7]+", UPPER + "234567"),
             ("[A-Za-z0-9]+", UPPER + LOWER + DIGITS), (".+", UPPER + LOWER + DIGITS + "+/"))
CELLS_PER_DECADE, DECADES = 100, 300
SPAN = "array<struct<start:bigint,kind:int,end:bigint,text:string>>"


def _spans(found: str, pieces, kind: int, keep):
    """Matches in ``found`` and the pieces around them -> array of (start, kind, end, text)."""
    lengths = F.zip_with(F.col(found), F.slice(pieces, 1, F.size(found)), lambda m, p: (F.length(m) + F.length(p)).cast("long"))
    spans = F.zip_with(F.col(found), running(lengths), lambda m, end: F.struct(
        (end - F.length(m)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("text")))
    return F.when(F.size(found) > 0, F.filter(spans, lambda s: keep(s["text"]))).otherwise(F.array().cast(SPAN))


def _outside(runs, base):
    """The ``runs`` that lie in no span of ``base``: in the order of their starts, those
    that end behind the furthest end of the spans begun before."""
    row = lambda s, which: F.struct(s["start"].alias("start"), F.lit(which).alias("which"), s["end"].alias("end"), s.alias("span"))
    both = F.sort_array(F.concat(F.transform(base, lambda s: row(s, 0)), F.transform(runs, lambda s: row(s, 1))))

    def beyond(rows):
        furthest = running(F.transform(rows, lambda r: F.when(r["which"] == 0, r["end"]).otherwise(F.lit(0).cast("long"))), F.greatest)
        free = F.zip_with(rows, furthest, lambda r, end: F.when((r["which"] == 1) & (r["end"] > end), r["span"]))
        return F.filter(free, lambda s: s.isNotNull())

    return F.when(F.size(base) > 0, let(both, beyond)).otherwise(runs)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, candidates): the rules' spans in order, and the runs to be tested outside them."""
    rules = (ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_ASSIGNED), (ACCESS, None), (HEX, None), (CANDIDATE, None)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for k, (pattern, _) in enumerate(rules):
        rows = rows.withColumn(f"m{k}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    for k, (pattern, keep) in enumerate(rules):
        rows = rows.withColumn(f"s{k}", _spans(f"m{k}", F.split("text", pattern, -1), k, keep or (lambda m: F.lit(True))))
    rows = rows.select("id", F.sort_array(F.concat("s0", "s1", "s2")).alias("base"), F.col("s3").alias("runs"))
    return rows.select("id", "base", _outside(F.col("runs"), F.col("base")).alias("candidates"))


def _upper_tail(z):
    """1 - Phi(z) by a logistic approximation, good to 2e-4 near the middle and monotone far out."""
    z = F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def tested(strings: DataFrame, col: str = "text") -> DataFrame:
    """``strings`` plus encoding (size of the alphabet), chi_p, runs_p, serial_p and p."""
    body = F.rtrim(F.translate(F.col(col), "-_", "+/"), F.lit("="))
    rows = strings.withColumn("_s", body)
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(F.col("_s").rlike(f"^{pattern}$"), F.lit(letters)).otherwise(alphabet)
    rows = rows.withColumn("_a", alphabet).withColumn("_k", F.length("_a").cast("double")).withColumn("_n", F.length("_s").cast("double"))
    rows = rows.withColumn("_c", F.split("_s", "")).withColumn("_v", F.transform("_c", lambda c: F.instr(F.col("_a"), c).cast("double")))
    squares = F.aggregate(F.array_distinct("_c"), F.lit(0.0), lambda a, c: a + F.pow(F.col("_n") - F.length(F.replace(F.col("_s"), c, F.lit(""))), 2))
    rows = rows.withColumn("_sq", squares).withColumn("_mean", F.aggregate("_v", F.lit(0.0), lambda a, v: a + v) / F.col("_n"))
    rows = rows.withColumn("_hi", F.transform("_v", lambda v: F.when(v > F.col("_k") / 2, 1.0).otherwise(0.0)))
    one, two = (lambda c: F.slice(c, 1, F.size(c) - 1)), (lambda c: F.slice(c, 2, F.size(c) - 1))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    m = F.col("_mean")
    rows = (rows.withColumn("_runs", 1 + total(F.zip_with(one("_hi"), two("_hi"), lambda a, b: F.abs(a - b)))).withColumn("_n1", total("_hi"))
            .withColumn("_cov", total(F.zip_with(one("_v"), two("_v"), lambda a, b: (a - m) * (b - m))))
            .withColumn("_var", total(F.transform("_v", lambda v: (v - m) * (v - m)))))
    n, k, n1 = F.col("_n"), F.col("_k"), F.col("_n1")
    df = k - 1
    chi = F.greatest(k / n * F.col("_sq") - n, F.lit(0.0))
    chi_z = (F.pow(chi / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    expected = 2 * n1 * (n - n1) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    runs_p = F.when(spread > 0, 2 * _upper_tail(F.abs(F.col("_runs") - expected) / F.sqrt(F.greatest(spread, F.lit(1e-9))))).otherwise(F.pow(F.lit(2.0), 1 - n))
    serial = F.col("_cov") / F.greatest(F.col("_var"), F.lit(1e-9)) + 1 / (n - 1)
    serial_p = F.when(F.col("_var") > 0, 2 * _upper_tail(F.abs(serial) * F.sqrt(n))).otherwise(0.0)
    rows = rows.withColumns({"encoding": k.cast("int"), "chi_p": _upper_tail(chi_z), "runs_p": runs_p, "serial_p": serial_p})
    return rows.withColumn("p", F.least(F.lit(1.0), 3 * F.least("chi_p", "runs_p", "serial_p"))).drop(
        *[c for c in rows.columns if c.startswith("_")])


def _weight(col: str = "text"):
    """Length of a candidate as its weight in the cut."""
    return F.least(F.length(col), F.lit(128)).cast("double")


def _cell(p, mean_weight: float):
    """Cell of a weighted p-value, counted from the smallest; wider cells never cut more."""
    decades = F.log10(F.greatest(p * mean_weight / _weight(), F.lit(10.0 ** -(DECADES - 1))))
    return F.ceil((decades + DECADES) * CELLS_PER_DECADE).cast("long")


def cut(strings: DataFrame, rate: float) -> tuple[float, int]:
    """Distinct candidates with p -> mean weight, and the last cell of those that are not random (-1: none)."""
    n, mean = strings.agg(F.count(F.lit(1)), F.avg(_weight())).first()
    if not n:
        return 1.0, -1
    cells = strings.groupBy(_cell(F.col("p"), mean).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    below = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))  # a fixed number of cells
    bound = F.pow(F.lit(10.0), F.col("cell") / CELLS_PER_DECADE - DECADES)
    last = cells.withColumn("below", below).where(bound <= rate * F.col("below") / n).agg(F.max("cell")).first()[0]
    return mean, -1 if last is None else last


def scan(docs: DataFrame, rate: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): spans of the rules, and of random strings outside them, each (start, kind, end, text)."""
    found = staged(find(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "secret-found")
    runs = tested(found.select("row", F.explode("candidates").alias("span")).select("row", "span", "span.text"))
    runs = staged(runs.select("row", "span", "text", "p"), "secret-runs")
    mean, last = cut(runs.groupBy("text").agg(F.min("p").alias("p")), rate)
    random = runs.where(_cell(F.col("p"), mean) > last).groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("added"))
    added = staged(random, "secret-random")
    rows = found.join(added, "row", "left")
    return rows.select("id", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"))


def listed(spans):
    """Spans by start, then kind as listed -> ``kind:start:end,...``"""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
