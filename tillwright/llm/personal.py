"""Personal data: spans of fixed kinds, and further identifiers found by the contexts that these stand in.

Base spans come from one pattern per kind and a check. They and keys (long runs of hexadecimal digits, which no text
holds by chance) are the seeds of a bootstrap: the words and signs before an entity are its lexical pattern, and
patterns and instances form a graph. In each round a pattern is worth the
share of its occurrences, before whatever word, that introduce an instance, each weighted by its worth (seeds 1), and
an unknown instance is worth what its best pattern is. So "the " is worth nothing, as it introduces all sorts of
words. Instances that a pattern of high confidence introduces become spans of kind "id", unless they overlap a base
span; a key is a span only where such a pattern introduces it.

Only DataFrame functions are used. Positions follow from the lengths of the pieces between matches; patterns are
written so that a text is read in linear time and without recursion.

Defined results: positions count code points, ends are exclusive; a null text is an empty one and has no spans; rows
that agree in doc_id and text get the same spans; the number of spans of a kind counts base spans only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import stage

# Fixed values. A match may begin where a run begins, or where the match before ended; that and possessive repeats
# leave the matches as they are but keep the search linear.
_LOCAL, _LABEL = r"[A-Za-z0-9._%+\-]", r"[A-Za-z0-9\-]"
KINDS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
# What a text must hold for a match of the kind to be possible.
_NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20\-]?[0-9]", "phone": r"\+[0-9]"}

# Instances beyond the seeds: runs with a digit or an at sign.
_RUN = r"[\p{L}0-9@._%+/\-]"
TOKEN = rf"(?<!{_RUN})(?=[\p{{L}}._%+/\-]*+[0-9@]){_RUN}++"
LEAST_TOKEN = 6
# Of these, the ones that are seeds: digests and access keys, with both letters and digits.
KEY = r"^(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}$"
# The last word and the signs between it and an instance, or between it and any next word.
CONTEXT_CHARS = 32
_SIGNS = r"[^\p{L}0-9@._%+/\-]"
CONTEXT = rf"\p{{L}}++{_SIGNS}++$"
CONTEXTS = rf"\p{{L}}++{_SIGNS}++(?={_RUN})"

ROUNDS = 3
# A pattern needs so many different seeds, and this worth.
LEAST_SEEDS = 5
CONFIDENT = 0.7

_SPAN = "array<struct<kind: string, start: int, end: int, instance: string, context: string>>"
_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """The sum before each entry, block by block, so that many entries don't take their square in time."""

    def block(array: Column, b: Column) -> Column:
        return F.slice(array, b * _BLOCK + 1, F.lit(_BLOCK))

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda a, x: a + x)

    def sums(array: Column, start: Column) -> Column:
        grown = F.aggregate(array, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(grown, 1, F.size(array))

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    return let(
        F.transform(blocks, lambda b: total(block(lengths, b))),
        lambda totals: let(
            sums(totals, F.lit(0)),
            lambda starts: F.flatten(
                F.transform(blocks, lambda b: sums(block(lengths, b), F.element_at(starts, b + 1)))
            ),
        ),
    )


def _even(context: Column) -> Column:
    return F.regexp_replace(F.lower(F.right(context, F.lit(CONTEXT_CHARS))), r"\s+", " ")


def _context(before: Column) -> Column:
    return _even(F.regexp_extract(F.right(before, F.lit(2 * CONTEXT_CHARS)), CONTEXT, 0))


def occurrences(text: Column) -> Column:
    """The contexts of all words of a text."""
    return F.transform(F.regexp_extract_all(text, F.lit(CONTEXTS), F.lit(0)), _even)


def matches(text: Column, kind: str, pattern: str, needed: str) -> Column:
    """All matches of a pattern as (kind, start, end, instance, context)."""

    def located(found: Column) -> Column:
        matched, before = found["m"], found["s"]
        lengths = F.zip_with(matched, F.slice(before, 2, F.size(matched)), lambda m, s: F.length(m) + F.length(s))

        def build(starts: Column, lead: Column) -> Column:
            return F.transform(
                F.arrays_zip(matched.alias("m"), F.slice(before, 1, F.size(matched)).alias("s"), starts.alias("b")),
                lambda x: F.struct(
                    F.lit(kind).alias("kind"),
                    (lead + x["b"]).alias("start"),
                    (lead + x["b"] + F.length(x["m"])).alias("end"),
                    x["m"].alias("instance"),
                    _context(x["s"]).alias("context"),
                ),
            )

        # each is counted once for all matches
        spans = let(
            lengths,
            lambda own: let(_running(own), lambda starts: let(F.length(F.element_at(before, 1)), lambda lead: build(starts, lead))),
        )
        return F.when(F.size(matched) > 0, spans).otherwise(F.array().cast(_SPAN))

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("s")
    )
    return F.when(text.rlike(needed), let(found, located)).otherwise(F.array().cast(_SPAN))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is right."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str) -> Callable[[Column], Column]:
    """Whether a match of the kind is a span."""

    def small(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+", "")
        return (F.length(digits) <= 3) & (F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)

    return {
        "email": lambda x: F.lit(True),
        "ip": lambda x: F.forall(F.split(x["instance"], r"\."), small),
        "card": lambda x: let(_digits(x["instance"]), lambda d: F.length(d).between(13, 19) & luhn(d)),
        "phone": lambda x: F.length(_digits(x["instance"])).between(9, 15),
    }[kind]


def base_spans(text: Column) -> Column:
    """The spans of all kinds, in the order of KINDS, then of their starts."""
    kinds = []
    for kind, pattern in KINDS.items():
        found = matches(text, kind, pattern, _NEEDS[kind])
        kinds.append(F.filter(found, _valid(kind)))
    return F.concat(*kinds)


def tokens(text: Column) -> Column:
    """Further candidates for identifiers."""
    found = matches(text, "id", TOKEN, "[0-9@]")
    return F.filter(found, lambda x: (F.length(x["instance"]) >= LEAST_TOKEN) & x["instance"].rlike("[0-9]"))


def confident_patterns(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """(context, worth) of the patterns to trust.

    edges: distinct (context, instance, seed, times); texts: all texts, in which patterns are counted.
    Worth is rounded in each round, so that it doesn't depend on the order of sums.
    """
    likely = edges.groupBy("context").agg(F.count_if("seed").alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS)
    counted = texts.select(F.explode(occurrences(F.coalesce("text", F.lit("")))).alias("context"))
    counted = counted.groupBy("context").agg(F.count(F.lit(1)).alias("occurs"))
    likely = stage(likely.join(counted, "context"), "likely_patterns")
    edges = stage(edges.join(likely.select("context", "occurs"), "context"), "likely_edges")
    instances = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    own = F.when(F.col("seed"), 1.0)
    worth = instances.select("instance", own.otherwise(0.0).alias("worth"))
    for _ in range(ROUNDS):
        found = edges.join(worth, "instance").groupBy("context").agg(
            F.round(F.sum(F.col("times") * F.col("worth")) / F.greatest(F.first("occurs"), F.sum("times")), 6)
            .alias("worth")
        )
        patterns = stage(found, "patterns")
        best = edges.select("context", "instance").join(patterns, "context").groupBy("instance").agg(
            F.max("worth").alias("best")
        )
        worth = instances.join(best, "instance").select("instance", own.otherwise(F.col("best")).alias("worth"))
    return patterns.where(F.col("worth") >= CONFIDENT)


def alone(mentions: DataFrame) -> DataFrame:
    """The mentions without the candidates that overlap a base span of the same text.

    Of the base spans that begin before a candidate the one that ends last tells, of the others the one that begins
    first; both are running values over the mentions of a text in order.
    """
    text = Window.partitionBy("doc_id", "version")
    forth = text.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    back = text.orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(forth)
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(back)
    overlaps = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    return mentions.withColumn("overlaps", overlaps).where(F.col("base") | ~F.col("overlaps")).drop("overlaps")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of kind, start, end, instance, context), further (array of start, end)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", F.xxhash64(text).alias("version"), base_spans(text).alias("base"), tokens(text).alias("tokens"))
    found = stage(found, "spans")
    mentions = found.select("doc_id", "version", F.explode(F.concat("base", "tokens")).alias("m"))
    own = F.col("m.kind") != "id"
    mentions = mentions.select(
        "doc_id", "version", "m.start", "m.end", "m.context", "m.instance", own.alias("base"),
        (own | F.col("m.instance").rlike(KEY)).alias("seed"),
    )
    mentions = mentions.groupBy(*mentions.columns).agg(F.count(F.lit(1)).alias("times"))
    named = stage(alone(mentions).where(F.col("context") != ""), "mentions")
    edges = named.groupBy("context", "instance").agg(F.max("seed").alias("seed"), F.sum("times").alias("times"))
    trusted = confident_patterns(stage(edges, "edges"), docs.select("text"))
    further = named.where("NOT base").join(trusted, "context").groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("further")
    )
    further = further.withColumnsRenamed({"doc_id": "id", "version": "of"})
    joined = found.join(further, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("of")), "left")
    none = F.array().cast("array<struct<start: int, end: int>>")
    return joined.select("doc_id", "base", F.coalesce("further", none).alias("further"))


def _joined(array: Column, kind: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", kind(x), x["start"], x["end"])), ",")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x == kind


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, all spans as text, and the number of further ones."""
    found = spans(docs)
    base = _joined(F.col("base"), lambda x: x["kind"])
    further = _joined(F.col("further"), lambda _: F.lit("id"))
    counts = [
        F.size(F.filter(F.transform("base", lambda x: x["kind"]), _is(kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(further, F.lit(""))).alias("spans"),
        F.size("further").cast("bigint").alias("n_further"),
    )
