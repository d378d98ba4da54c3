"""Secrets in texts, and weak candidates that only count beside their complement.

Certain spans (assigned secrets, access ids, long hexadecimal runs) are reported wherever they are. Other parts
of a credential are weak on their own: a user or client id, an unnamed key-like token, a
service address. A weak part is reported only when the parts that complete it lie in its scope, at
most ``SCOPE`` code points away: an id needs a secret, a secret needs an id or an endpoint, an endpoint needs both an
id and a secret. That is an interval join: parts are cut into buckets of the scope's width, a weak part
looks into the buckets that its scope touches, and a semi join on bucket and role tests the distance,
so no pairs are made.

All of it is DataFrame operations. Positions come from the lengths of matches and of the text between
them, added up by a running sum, so long texts cost no more a match than short ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortry.scale import stage

#: Code points between two parts of one credential at most.
SCOPE = 200

ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    # Runs of the stated length are the maximal runs that reach it.
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "weak_id": r"""(?i:access_?key_?id|client_?id|account|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}""",
    "weak_secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]{0,64}[0-9])(?=[0-9+/_=-]{0,64}[A-Za-z])[A-Za-z0-9+/_=-]{20,}",
    "endpoint": r"""(?i:https?|ftp|ssh|jdbc:[a-z]{2,16}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+""",
}
#: Base kinds in the order of their contract, then the linked ones.
ORDER = {kind: i for i, kind in enumerate(PATTERNS)}
BASE = ("assign", "access", "hex")
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
#: For each weak kind, sets of roles; every set must have a part in scope.
NEEDS = {"weak_id": [("secret",)], "weak_secret": [("id", "endpoint")], "endpoint": [("id",), ("secret",)]}
LEAST_ASSIGNED = 8


def _matched(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_print, one array of (between, length, good) per kind): lengths in code points, null where nothing matches.

    ``row`` numbers the rows once and is kept by staging, so repeated ids stay apart.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = rows.select("doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in PATTERNS.items()])

    def parts(kind: str) -> Column:
        value = F.col(kind)
        between = F.split("text", PATTERNS[kind], -1)
        good = (
            (lambda m: F.length(F.regexp_extract(m, f"^{ASSIGN}", 1)) >= LEAST_ASSIGNED) if kind == "assign" else (lambda m: F.lit(True))
        )
        both = F.zip_with(value, between, lambda m, b: F.struct(F.length(b).alias("between"), F.length(m).alias("length"), good(m).alias("good")))
        # zip_with is as long as the longer list; the last piece stands behind all matches.
        return F.when(F.size(value) > 0, F.slice(both, 1, F.size(value))).alias(kind)

    return stage(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_print"), *[parts(k) for k in PATTERNS]))


def _parts(matched: DataFrame) -> DataFrame:
    """(row, kind, start, stop) of every good match."""
    kinds = [matched.where(F.col(k).isNotNull()).select("row", F.lit(k).alias("kind"), F.posexplode(k)) for k in PATTERNS]
    before = Window.partitionBy("row", "kind").orderBy("pos")
    stop = F.sum(F.col("col.between") + F.col("col.length")).over(before)
    return (
        reduce(DataFrame.unionByName, kinds)
        .withColumn("stop", stop.cast("long"))
        .where("col.good")
        .select("row", "kind", (F.col("stop") - F.col("col.length")).alias("start"), "stop")
    )


def _buckets(start: Column, stop: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / SCOPE), F.floor(stop / SCOPE)))


def _linked(parts: DataFrame) -> DataFrame:
    """The weak parts that stand apart from certain ones and have their complement in scope."""
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])

    def placed(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("row").alias("p_row"), F.col("start").alias("from"), F.col("stop").alias("to"), role[F.col("kind")].alias("role"),
            _buckets(F.col("start"), F.col("stop")).alias("p_bucket"),
        )

    same = (F.col("row") == F.col("p_row")) & (F.col("bucket") == F.col("p_bucket"))
    certain = parts.where(F.col("kind").isin(*BASE))
    weak = parts.where(~F.col("kind").isin(*BASE))
    # A weak part that overlaps a certain one is a view of the same characters.
    looking = weak.select("*", _buckets(F.col("start"), F.col("stop")).alias("bucket"))
    seen = looking.join(placed(certain), same & (F.col("from") < F.col("stop")) & (F.col("start") < F.col("to")), "left_semi")
    weak = stage(weak.join(seen.select("row", "kind", "start").distinct(), ["row", "kind", "start"], "left_anti").select(*parts.columns))
    partners = placed(certain.unionByName(weak))
    low, high = F.greatest(F.col("start") - SCOPE, F.lit(0)), F.col("stop") + SCOPE
    out = []
    for kind, needs in NEEDS.items():
        here = weak.where(F.col("kind") == kind)
        for roles in needs:
            looking = here.select("*", _buckets(low, high).alias("bucket"))
            near = same & (F.col("from") <= F.col("stop") + SCOPE) & (F.col("to") >= F.col("start") - SCOPE)
            here = looking.join(partners.where(F.col("role").isin(*roles)), near, "left_semi").drop("bucket").distinct()
        out.append(here)
    return reduce(DataFrame.unionByName, out)


def _joined(condition: Column) -> Column:
    """kind:start:stop of the spans that meet the condition, by start, then kind, comma-joined."""
    rank = F.create_map(*[F.lit(x) for pair in ORDER.items() for x in pair])
    span = F.struct(F.col("start"), rank[F.col("kind")].alias("rank"), F.concat_ws(":", "kind", "start", "stop").alias("span"))
    return F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.when(condition, span))), lambda s: s["span"]))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row; spans holds all, base ones included.

    Null and empty texts have no spans; repeated rows are reported each; no rows give no rows. Only id and text are read.
    """
    matched = _matched(docs)
    found = _with_links(matched)
    base = F.col("kind").isin(*BASE)
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE]
    by_row = found.groupBy("row").agg(*counts, _joined(base).alias("base"), _joined(F.lit(True)).alias("spans"))
    return matched.select("row", "doc_id").join(by_row, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def _with_links(matched: DataFrame) -> DataFrame:
    parts = stage(_parts(matched))
    return parts.where(F.col("kind").isin(*BASE)).unionByName(_linked(parts))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; n_chars, where there is one, is counted anew.

    Overlapping spans are one. A row finds its spans by id and text, so repeated ids keep their own; rows
    without spans stay as they are.
    """
    matched = _matched(docs)
    ordered = F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_spans")
    found = _with_links(matched).groupBy("row").agg(ordered).join(matched, "row")
    found = found.select(F.col("doc_id").alias("_doc"), F.col("text_print").alias("_print"), "_spans").dropDuplicates(["_doc", "_print"])
    own = docs["doc_id"].cast("long").eqNullSafe(found["_doc"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_print"])
    text, begin = docs["text"], F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def passed(done: Column, span: Column) -> Column:
        upto = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        apart = (span["start"] > done["at"]) | (done["at"] == 0)
        return F.struct(F.greatest(done["at"], span["stop"]).alias("at"), F.when(apart, F.concat(done["out"], upto, F.lit(mark))).otherwise(done["out"]).alias("out"))

    rest = lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
    clean = F.when(found["_spans"].isNull(), text).otherwise(F.aggregate(found["_spans"], begin, passed, rest))
    joined = docs.join(found, own, "left")
    out = [clean.alias(c) if c == "text" else F.length(clean).cast("long").alias(c) if c == "n_chars" else docs[c] for c in docs.columns]
    return joined.select(*out)
