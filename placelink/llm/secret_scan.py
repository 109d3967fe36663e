"""Operator 8, secret scans: corpus-wide ownership frequency. DataFrame functions only.

Each text is scanned once for candidates (kind, span, hash of the value); the candidates, without any text, go to a
table. Hashes are counted by distinct owners and repositories, repositories within owners first, so a value that a third
of all rows share shrinks in the map-side combine. A value of at least ``WIDESPREAD`` owners, or of at least ``REPOSITORIES``
repositories of fewer owners, is a widely copied example, any other is live-looking: one owner's key stands in a few places. Base spans stay in either case; ``known`` spans (keys of known issuers) are the method's own and
stand only where the value is live. The join of candidates with their counts is one that AQE may split by rows.

Defined cases: a null or empty text has no span; null owners and repositories count as one each; repeated rows are
scanned each by itself (a row's key is its own, not the id); extra columns pass through ``redacted``.
Positions are code points, ends exclusive. Places come from prefix sums by blocks, so a text of many matches takes time near
proportion to its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rules import _let
from .storage import table, unused, written

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KNOWN = (
    r"gh[opusr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}|-----BEGIN [A-Z ]*PRIVATE KEY-----"
)
KINDS = ("assign", "access", "hex", "known")
MIN_ASSIGNED = 8
WIDESPREAD = 3
REPOSITORIES = 100
#: Items of a block of running sums and maxima.
RUN = 128

_SPAN = "array<struct<start:int,k:int,end:int,hash:string>>"


def _runs(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``step`` over an array, each with its item. Within blocks, then over blocks: folds that append stay short."""

    def running(some: Column, first: Column) -> Column:
        grow = lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x)))
        return F.aggregate(some, F.array(first), grow)  # what lies before each item, and the whole

    count = F.ceil(F.size(items) / RUN).cast("int")
    blocks = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(items, k * RUN + 1, RUN)))
    inner = F.transform(blocks, lambda x: F.slice(running(x, start), 2, F.size(x)))

    def joined(got: Column) -> Column:
        before = F.slice(running(F.transform(got, lambda x: F.element_at(x, -1)), start), 1, F.size(got))
        return F.flatten(F.zip_with(got, before, lambda some, first: F.transform(some, lambda x: step(first, x))))

    return _let(inner, joined)


def _found(text: Column, k: int, pattern: str, guard: Column, value_group: int = 0, least: int = 0) -> Column:
    """Spans of a pattern's matches, leftmost and not overlapping: their places follow from what lies between them.

    ``guard`` is a cheap test that no text with a match fails. ``least`` drops matches whose value is shorter.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole

    def spans(gap: Column, match: Column, v: Column) -> Column:
        ends = _runs(F.zip_with(F.slice(gap, 1, F.size(match)), match, lambda g, m: g + F.length(m)), F.lit(0), lambda a, x: a + x)
        rows = F.filter(F.arrays_zip(ends.alias("end"), match.alias("match"), v.alias("v")), lambda x: F.length(x["v"]) >= least)
        return F.transform(rows, lambda x: F.struct((x["end"] - F.length(x["match"])).alias("start"), F.lit(k).alias("k"), x["end"].alias("end"), F.sha2(x["v"].cast("binary"), 256).alias("hash")))

    found = _let(between, lambda gap: _let(whole, lambda match: _let(value, lambda v: spans(gap, match, v))))
    return F.when(guard, found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def candidates(text: Column) -> Column:
    """All candidates of a text, by kind and place."""
    text = F.coalesce(text, F.lit(""))
    # Each guard is the pattern with the least length in it: a text without such a match has no span of the kind.
    assigned = text.rlike(ASSIGN[: -len("+)")] + "{" + str(MIN_ASSIGNED) + ",})")
    return F.concat(
        _found(text, 0, ASSIGN, assigned, 2, MIN_ASSIGNED),
        _found(text, 1, ACCESS, text.contains("AKIA")),
        _found(text, 2, HEX, text.rlike(HEX)),
        _found(text, 3, KNOWN, text.rlike(KNOWN)),
    )


def scan(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(uid, *keep, spans) for each row of ``docs``; spans: array of (start, k, end, live), by start and kind, with base spans all and ``known`` ones where live.

    k is the place in KINDS. uid is a key of the row within this call's result.
    """
    found = written(
        docs.select(*[F.col(c).alias(f"keep_{c}") for c in keep], F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repository_col).cast("string"), F.lit("")).alias("repository"), candidates(F.col(text_col)).alias("found"))
        .withColumn("uid", F.monotonically_increasing_id()),
        "secret-candidates",
    )
    each = found.where(F.size("found") > 0).select("uid", "owner", "repository", F.explode("found").alias("c"))
    owned = each.groupBy(F.col("c.hash").alias("hash"), "owner", "repository").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    counts = written(owned.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")), "secret-owners")
    judged = each.select("uid", "c.*").join(counts.withColumnRenamed("hash", "h"), F.col("hash") == F.col("h"))
    live = (F.col("owners") < WIDESPREAD) & (F.col("repositories") < REPOSITORIES)
    kept = judged.where((F.col("k") < 3) | live).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "k", "end", live.alias("live")))).alias("spans"))
    none = F.array().cast("array<struct<start:int,k:int,end:int,live:boolean>>")
    return found.drop("owner", "repository", "found").join(kept, "uid", "left").select("uid", *[F.col(f"keep_{c}").alias(c) for c in keep], F.coalesce("spans", none).alias("spans"))


def masked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with its spans (by start) replaced by ``mark``, overlapping ones once."""

    def pieces(items: Column) -> Column:
        # Each item with the end of what lies before it; the text is cut by blocks first, as finding a place takes time from a text's begin.
        count = F.ceil(F.size(items) / RUN).cast("int")

        def block(k: Column) -> Column:
            some = F.slice(items, k * RUN + 1, RUN)
            base = F.element_at(some, 1)["at"]
            upto = F.coalesce(F.get(items, (k + 1) * RUN)["at"], F.length(text))
            part = lambda t: F.transform(some, lambda x: F.when(x["start"] >= x["at"], F.concat(F.substring(t, x["at"] - base + 1, x["start"] - x["at"]), F.lit(mark))).otherwise(""))
            return _let(F.substring(text, base + 1, upto - base), part)

        return F.flatten(F.transform(F.sequence(F.lit(0), count - 1), block))

    ends = _runs(F.transform(spans, lambda x: x["end"]), F.lit(0), lambda a, x: F.greatest(a, x))

    def whole(after: Column) -> Column:
        items = F.zip_with(spans, F.concat(F.array(F.lit(0)), F.slice(after, 1, F.size(after) - 1)), lambda s, at: F.struct(at.alias("at"), s["start"].alias("start")))
        return _let(items, lambda x: F.concat(F.array_join(pieces(x), ""), F.substring(text, F.element_at(after, -1) + 1, F.length(text))))

    return _let(ends, whole)


def redacted(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the spans of live secrets replaced by ``mark``; other rows, columns and widely copied examples stay.

    Overlapping spans are replaced once. A column n_chars, if there, follows the text.
    """
    row, at = unused(docs, "__row"), unused(docs, "__spans")
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "secret-rows")
    live = scan(keyed, text_col, owner_col, repository_col, keep=(row,)).select(F.col(row), F.filter("spans", lambda s: s["live"]).alias(at)).where(F.size(at) > 0)
    text = F.col(text_col)
    out = keyed.join(live, row, "left").withColumn(text_col, F.when(F.col(at).isNull(), text).otherwise(masked(text, F.col(at), mark)))
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else out.select(docs.columns)


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(table(spark, sf_dir, "documents"), keep=("doc_id",))
    count = lambda k: F.size(F.filter("spans", lambda s: s["k"] == k)).cast("long")
    return got.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_listed(F.filter("spans", lambda s: s["k"] < 3)).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def _oracle() -> str:
    def found(k: int, pattern: str, group: int, least: int) -> str:
        p = pattern.replace("'", "''")
        return f"""SELECT doc_id, owner, repository, {k} AS k, unnest(list_transform(range(1, len(m) + 1), lambda i:
            {{'start': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0), 'n': length(m[i]), 'v': v[i]}})) AS s, {least} AS least
          FROM (SELECT doc_id, owner, repository, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {group}) AS v, regexp_split_to_array(text, '{p}') AS g FROM d WHERE regexp_matches(text, '{p}'))"""

    parts = "\nUNION ALL\n".join(found(*x) for x in ((0, ASSIGN, 2, MIN_ASSIGNED), (1, ACCESS, 0, 0), (2, HEX, 0, 0), (3, KNOWN, 0, 0)))
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(doc_id::VARCHAR, '') AS repository, coalesce(text, '') AS text FROM documents),
     c AS (SELECT doc_id, owner, repository, k, s.start::BIGINT AS a, (s.start + s.n)::BIGINT AS b, s.v AS v FROM ({parts}) WHERE length(s.v) >= least),
     o AS (SELECT v, count(DISTINCT owner) < {WIDESPREAD} AND count(DISTINCT (owner, repository)) < {REPOSITORIES} AS live FROM c GROUP BY v),
     j AS (SELECT c.*, live, ['assign', 'access', 'hex', 'known'][k + 1] || ':' || a || ':' || b AS t FROM c JOIN o USING (v) WHERE k < 3 OR live),
     g AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
                  coalesce(string_agg(t, ',' ORDER BY a, k) FILTER (WHERE k < 3), '') AS base, string_agg(t, ',' ORDER BY a, k) AS spans, count(*) FILTER (WHERE live) AS n_live FROM j GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (doc_id)
"""


QUERIES = {"op8_secrets": op8_secrets}
ORACLES = {"op8_secrets": _oracle()}
