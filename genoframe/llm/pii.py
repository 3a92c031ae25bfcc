"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Base spans are the leftmost non-overlapping matches of four patterns, each
checked afterwards (address parts, Luhn sum, digit counts).

Bootstrapping: tokens that look like identifiers (a digit or ``@`` in them) are
instances.  A lexical pattern is the two words before an instance, once alone
and once with the instance's shape (letters and digits collapsed).  Base
entities are the first seeds.  In each round the patterns with enough distinct
confirmed values are scored by their values, unseen values by the patterns they
stand in, and values of a high score join the seeds, so that patterns which no
base entity stands in are reached through discovered ones.  In the end the
unseen instances of confident patterns give spans.

Everything is a column expression or a grouped aggregate; rows that leave the
text are matches, never characters.  Patterns with too few distinct values ever
to count leave the graph before the rounds.  A pattern or a value on a third of
all rows is combined per task first.

Matches are found with possessive quantifiers and a start condition, which give
the same matches as the plain patterns in linear time on very long texts.

Defined cases: null text is empty; an empty text has no spans; an empty table
gives an empty result; rows that repeat id and text are treated alike; extra
columns play no part.  Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genoframe.session import stored

from .common import keyed, small

DOC = ["_doc", "_h"]
KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A match starts where its first run of characters starts, or where the last match ended.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PHONE,
}
#: Texts without a match of the gate have no match of the pattern.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
INSTANCE = rf"{PHONE}|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"


def matches(docs: DataFrame, pattern: str, gate: str) -> DataFrame:
    """(_doc, _h, start, end, before, value) of all matches in keyed ``docs``;
    ``before`` is the text since the last match."""
    text = F.col("_text")
    parts = (
        docs.filter(text.rlike(gate))
        .select(
            *DOC,
            F.posexplode(
                F.arrays_zip(F.split(text, pattern).alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
            ).alias("_n", "_m"),
        )
        .filter(F.col("_m.value").isNotNull())
        .select(*DOC, "_n", F.char_length("_m.before").alias("_gap"), F.col("_m.before").substr(F.lit(-80), F.lit(80)).alias("_tail"),
                F.when(F.char_length("_m.before") <= 80, F.col("_m.before")).alias("_short"), F.col("_m.value").alias("value"))
        .withColumn("before", F.coalesce("_short", "_tail"))
        .drop("_short", "_tail")
        .distinct()
    )
    upto = F.sum(F.col("_gap") + F.char_length("value")).over(
        W.partitionBy(*DOC).orderBy("_n").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return parts.withColumn("end", upto).select(
        *DOC, (F.col("end") - F.char_length("value")).alias("start"), "end", "before", "value"
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(value: Column) -> Column:
    """Luhn check of up to 19 digits."""
    turned, total = F.reverse(_digits(value)), F.lit(0)
    for k in range(19):
        digit = F.coalesce(F.substring(turned, k + 1, 1).try_cast("int"), F.lit(0))
        total = total + (F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2) if k % 2 else digit)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    count = F.char_length(_digits(value))
    if kind == "ip":
        plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(plain, lambda p: (F.char_length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return count.between(13, 19) & luhn(value)
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """(_doc, _h, kind, start, end): the fixed patterns, over keyed ``docs``."""
    out = None
    for kind in KINDS:
        found = matches(docs, PATTERNS[kind], GATES[kind]).filter(valid(kind, F.col("value")))
        found = found.select(*DOC, F.lit(kind).alias("kind"), "start", "end")
        out = found if out is None else out.unionByName(found)
    return out


def plausible(kind: str, value: Column) -> Column:
    """Whether an unseen ``value`` may be of ``kind`` at all: an address needs
    its ``@``, a number four digits."""
    address = value.contains("@")
    return address if kind == "email" else ~address & (F.char_length(_digits(value)) >= 4)


def instances(docs: DataFrame) -> DataFrame:
    """(_doc, _h, start, end, value, seed, may, patterns): identifier-like tokens,
    without punctuation around them; the kind of base entities; the kinds that
    others may have; and their lexical patterns, with and without the shape.
    Values and patterns are 64-bit hashes."""
    found = matches(docs, INSTANCE, "[0-9@]")
    whole = F.col("value")
    core = F.regexp_replace(F.regexp_replace(whole, r"[\p{Punct}&&[^+]]+$", ""), r"^[\p{Punct}&&[^+(]]+", "")
    lead = F.char_length(F.regexp_extract(whole, r"^[\p{Punct}&&[^+(]]+", 0))
    words = F.filter(F.split(F.lower("before"), r"\s+"), lambda w: w != "")
    left = F.when(F.size(words) > 0, F.array_join(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), 2), " "))
    shape = F.regexp_replace(F.regexp_replace("core", r"\p{L}+", "a"), "[0-9]+", "9")
    seed = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        plain = PATTERNS[kind]
        seed = F.when(F.col("core").rlike(rf"^(?:{plain})$") & valid(kind, F.col("core")), kind).otherwise(seed)
    may = F.array_compact(F.array(*[F.when(plausible(k, F.col("core")), k) for k in KINDS]))
    # a place without words before it has a pattern only with the shape
    patterns = F.array_compact(F.array(F.xxhash64(F.coalesce(left, F.lit("")), shape), F.when(left.isNotNull(), F.xxhash64(left))))
    return (
        found.withColumn("core", core)
        .filter("core <> ''")
        .withColumn("start", F.col("start") + lead)
        .withColumn("end", F.col("start") + F.char_length("core"))
        .select(*DOC, "start", "end", F.xxhash64("core").alias("value"), seed.alias("seed"), may.alias("may"), patterns.alias("patterns"))
    )


def bootstrap(found: DataFrame, rounds: int = 4, support: int = 3, confidence: float = 0.8, smoothing: float = 1.0) -> DataFrame:
    """(_doc, _h, kind, start, end): unseen instances of confident patterns, over
    the stored instances ``found``.

    A pattern speaks for a kind once ``support`` distinct confirmed values of the
    kind stand in it.  Its trust is the summed score of its places over their
    number (smoothed).  An unseen value's score is the noisy-or of the patterns
    that speak for it; from ``confidence`` on it is confirmed and supports
    further patterns in the next round, as the base entities do."""
    edges = found.select("value", "seed", "may", F.explode("patterns").alias("pattern"))
    edges = edges.groupBy("pattern", "value").agg(F.first("seed").alias("seed"), F.first("may").alias("may"), F.count("*").alias("n"))
    edges = stored(edges, "pii-edges")
    total = edges.groupBy("pattern").agg(F.sum("n").alias("total"), F.count("*").alias("_values"))
    total = stored(total.filter(F.col("_values") >= support).drop("_values"), "pii-total")  # the others never speak
    edges = stored(edges.join(small(total), "pattern"), "pii-graph")
    known = edges.filter("seed IS NOT NULL").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores = known = stored(known, "pii-scores")
    for _ in range(rounds):
        trust = F.round(F.sum(F.col("n") * F.col("score")) / (F.first("total") + smoothing), 9)
        confirmed = F.count(F.when(F.col("score") >= confidence, 1))
        weight = edges.join(small(scores), "value").groupBy("pattern", "kind").agg(trust.alias("trust"), confirmed.alias("confirmed"))
        weight = stored(weight.filter(F.col("confirmed") >= support).drop("confirmed"), "pii-patterns")
        unseen = (
            edges.filter("seed IS NULL")
            .join(small(weight), "pattern")
            .filter(F.array_contains("may", F.col("kind")))
            .groupBy("value", "kind")
            .agg(F.round(1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999))))), 9).alias("score"))
        )
        scores = stored(known.unionByName(unseen), "pii-scores")
    good = small(stored(weight.filter(F.col("trust") >= confidence), "pii-good"))
    places = found.filter("seed IS NULL").select(*DOC, "start", "end", "may", F.explode("patterns").alias("pattern"))
    return (
        places.join(good, "pattern")
        .filter(F.array_contains("may", F.col("kind")))
        .groupBy(*DOC, "start", "end")
        .agg(F.max_by("kind", F.struct("trust", "kind")).alias("kind"))
    )


def find(docs: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """(_doc, _h, base, spans) per row of ``docs``: arrays of (kind, start, end),
    by kind and start; ``spans`` holds the base and the discovered ones."""
    rows = keyed(docs, text, doc)
    base = stored(base_spans(rows), "pii-base")
    more = bootstrap(stored(instances(rows), "pii-instances"), **options).alias("m")
    clash = (
        F.col("m._doc").eqNullSafe(F.col("b._doc"))
        & (F.col("m._h") == F.col("b._h"))
        & (F.col("m.start") < F.col("b.end"))
        & (F.col("b.start") < F.col("m.end"))
    )
    new = more.join(base.alias("b"), clash, "left_anti")
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    every = base.withColumn("own", F.lit(True)).unionByName(new.withColumn("own", F.lit(False)))
    span = F.struct(order.alias("order"), "start", "end", "kind", "own")
    lists = every.groupBy(F.col("_doc").alias("_d"), F.col("_h").alias("_g")).agg(F.sort_array(F.collect_set(span)).alias("_s"))
    joined = rows.select(*DOC).join(
        stored(lists, "pii-spans"), F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left"
    )
    spans = F.coalesce("_s", F.array().cast("array<struct<order:bigint,start:bigint,end:bigint,kind:string,own:boolean>>"))
    return joined.select(*DOC, F.filter(spans, lambda s: s["own"]).alias("base"), spans.alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
