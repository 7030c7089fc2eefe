"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

1. Candidates come from strict patterns (the base rules) and from looser ones: written-out
   addresses, numbers without a plus sign, cards with other separators, long addresses.
2. Labelers vote for, against or not at all: the strict rule, gazetteers (domain ends, card
   issuers, dialling codes, special ranges), words before the span, its grouping, its
   neighbours.
3. Expectation-maximisation over the counts of vote patterns (a few hundred rows whatever
   the input) estimates how reliable each labeler is, for spans and for other text.
4. The posteriors label all candidates softly, and a naive Bayes classifier is trained on
   features the labelers do not read: length, digits, distinct characters and the shapes
   at both ends. Votes and classifier together give the probability of a span.

Spans of the base rules always stay; other candidates are added if their probability
reaches ``least`` and they do not overlap a span. Texts are read whole, once; what is
shuffled is a row per document and per candidate. Only DataFrame operations.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.text import bind
from earshot.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
#: Characters of the text before and after a candidate that the labelers may read.
BEFORE, AFTER = 32, 4

#: Words that speak for or against a kind of data, and its usual beginnings or ends.
FOR_WORDS = {
    "email": "e-?mail|mail|contact|write|address|reach",
    "ip": "ip|host|server|address|from|ping|client|login",
    "card": "card|visa|mastercard|amex|credit|debit|payment|paid",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|dial|contact",
}
AGAINST_WORDS = {
    "email": "git|ssh|example",
    "ip": "version|release|section|chapter|v",
    "card": "isbn|order|invoice|tracking|serial|ref|id",
    "phone": "isbn|order|invoice|tracking|serial|ref|id|page",
}
GAZETTEER_FOR = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu)$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[ -]?[1-5]|2[ -]?[2-7]|3[ -]?[47]|6[ -]?(?:0[ -]?1[ -]?1|5))",
    "phone": r"^\+?\(?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
}
GAZETTEER_AGAINST = {
    "email": r"(?i)\.(?:png|jpg|gif|js|css|py|txt)$",
    "ip": r"^(?:0|24[0-9]|25[0-5])\.",
    "card": r"^(?:0|1|9)",
    "phone": r"^\+?0{3}",
}
GROUPING_FOR = {
    "email": r"^[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]+\.[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{4}([ .-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5})$",
    "phone": r"^(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4}){1,5}$|^\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}$",
}

#: At most 255: all zeros, or zeros and a number that begins with none.
_PART = "(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?))"


@dataclass(frozen=True)
class Source:
    """A pattern for candidates of a kind; ``gate`` is a cheap test that a text may hold one."""

    kind: str
    base: bool
    pattern: str
    gate: Callable[[Column], Column]


def _digit(text: Column) -> Column:
    return text.rlike("[0-9]")


#: Possessive repeats keep the matcher from recursing over long runs; they change no match,
#: since what follows never overlaps what is repeated. The look-behinds only skip starts
#: inside a run, which cannot match if its beginning does not; ``\\G`` admits the place
#: where the match before ended.
SOURCES = (
    Source(
        "email", True, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"),
    ),
    Source("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]")),
    Source("card", True, r"[0-9](?:[ -]?+[0-9])++", _digit),
    Source("phone", True, r"\+[0-9][ ().0-9-]+[0-9]", lambda t: t.contains("+")),
    Source(
        "email", False,
        r"(?i)(?<![a-z0-9])[a-z0-9]++(?:[._-][a-z0-9]++)*+ ?[\[(]at[\])] ?[a-z0-9-]++(?: ?[\[(]dot[\])] ?[a-z0-9-]++)++",
        lambda t: t.rlike(r"(?i)[\[(]at[\])]"),
    ),
    Source(
        "ip", False, r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
        lambda t: t.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"),
    ),
    Source("card", False, r"(?<![0-9.])[0-9]{4}([._])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9.])", _digit),
    Source(
        "phone", False, r"(?<![0-9A-Za-z+(. -])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z.-]*[0-9])",
        _digit,
    ),
)


def hits(text: Column, number: int, source: Source) -> Column:
    """Matches of one source in text order, each with the length of the gap before it."""
    pattern = F.lit(source.pattern)

    def built(found: Column) -> Column:
        return F.transform(found["hits"], lambda hit, i: F.struct(
            F.lit(number).alias("source"), i.alias("i"), F.length(F.get(found["gaps"], i)).alias("gap"), hit.alias("hit"),
            F.right(F.get(found["gaps"], i), F.lit(BEFORE)).alias("before"),
            F.left(F.get(found["gaps"], i + 1), F.lit(AFTER)).alias("after"),
        ))

    pair = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hits"), F.split(text, source.pattern, -1).alias("gaps")
    )
    none = F.array().cast("array<struct<source:int,i:int,gap:int,hit:string,before:string,after:string>>")
    return F.when(source.gate(text), bind(pair, built)).otherwise(none)


def by_kind(kind: Column, values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def strict(kind: Column, hit: Column) -> Column:
    """Whether a match of a base pattern passes the checks of its kind."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    count = F.length(digits)
    # the length is checked first, so that the checksum never sees a long run
    card = F.when(count.between(12, 19), F.expr("luhn_check(regexp_replace(hit, '[^0-9]', ''))")).otherwise(False)
    return by_kind(kind, {
        "email": F.lit(True), "ip": hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), "card": card,
        "phone": count.between(9, 15),
    })


def votes(kind: Column, hit: Column, before: Column, after: Column, base: Column, valid: Column) -> Column:
    """One digit per labeler: 2 for, 0 against, 1 abstains."""

    def vote(yes: Column, no: Column) -> Column:
        return F.when(F.coalesce(yes, F.lit(False)), "2").when(F.coalesce(no, F.lit(False)), "0").otherwise("1")

    def matched(value: Column, patterns: dict[str, str], form: str = "{}") -> Column:
        return by_kind(kind, {k: value.rlike(form.format(p)) for k, p in patterns.items()})

    word = r"(?i)(?<![a-z0-9])(?:{})[^a-z0-9]*+(?:[a-z]++[^a-z0-9]++)?$"
    glued = before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]")
    return F.concat(
        vote(base & valid, base & ~valid),
        vote(matched(hit, GAZETTEER_FOR), matched(hit, GAZETTEER_AGAINST)),
        vote(matched(before, FOR_WORDS, word), matched(before, AGAINST_WORDS, word)),
        vote(matched(hit, GROUPING_FOR), F.lit(False)),
        vote(~glued & (before.rlike(r"(?:^|[\s(<:,;])$") | (before == "")), glued),
    )


LABELERS = 5
#: Chances of a vote on spans and on other text before any is seen, and the votes they stand for.
START = {"2": (0.55, 0.15), "1": (0.3, 0.3), "0": (0.15, 0.55)}
BELIEF = 20.0
#: Values each feature of the classifier can take.
FEATURES = (24, 20, 12, 36)


def features(hit: Column) -> Column:
    """Small whole numbers: length, digits, distinct characters, shapes of the two ends."""
    digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))

    def shape(c: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), 0).when(c.rlike("[a-z]"), 1).when(c.rlike("[A-Z]"), 2)
            .when(c == "+", 3).when(c == "(", 4).otherwise(5)
        )

    distinct = F.size(F.array_distinct(F.split(F.left(hit, F.lit(64)), "")))
    return F.array(
        F.least(F.length(hit), F.lit(FEATURES[0] - 1)), F.least(digits, F.lit(FEATURES[1] - 1)),
        F.least(distinct, F.lit(FEATURES[2] - 1)),
        shape(F.left(hit, F.lit(1))) * 6 + shape(F.right(hit, F.lit(1))),
    )


def reliabilities(patterns: list[tuple[str, int]], rounds: int = 50) -> tuple[float, list[dict[str, tuple[float, float]]]]:
    """Prior of a span and, per labeler, vote -> (chance on spans, chance on other text).

    ``patterns`` are vote patterns with their counts. EM for two classes with votes that are
    independent given the class. Matches that pass the strict rule are spans by definition;
    ``BELIEF`` made-up votes per labeler, right about four times out of five, stand for what is
    assumed before any text is seen, and keep the two classes from changing places.
    """
    prior, chances = 0.5, [dict(START) for _ in range(LABELERS)]
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        sums = [{v: [BELIEF * a, BELIEF * b] for v, (a, b) in START.items()} for _ in range(LABELERS)]
        weight = [BELIEF, BELIEF]
        for pattern, n in patterns:
            p = posterior(pattern, prior, chances)
            weight[0] += n * p
            weight[1] += n * (1 - p)
            for labeler, vote in enumerate(pattern):
                sums[labeler][vote][0] += n * p
                sums[labeler][vote][1] += n * (1 - p)
        prior = weight[0] / (weight[0] + weight[1])
        chances = [{v: (a / weight[0], b / weight[1]) for v, (a, b) in s.items()} for s in sums]
    return prior, chances


def posterior(pattern: str, prior: float, chances: list[dict[str, tuple[float, float]]]) -> float:
    if pattern[0] == "2":
        return 1 - 1e-9
    odds = math.log(prior / (1 - prior))
    for labeler, vote in enumerate(pattern):
        a, b = chances[labeler][vote]
        odds += math.log(a / b)
    return 1 / (1 + math.exp(-max(min(odds, 50.0), -50.0)))


def candidates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per candidate, and one without a kind for each document without any."""
    full = F.coalesce(F.col(text), F.lit(""))
    every = bind(full, lambda t: F.concat(*[hits(t, n, s) for n, s in enumerate(SOURCES)]))
    # numbered before the candidates are exploded: the number stands for the document
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), every.alias("every")
    )
    rows = rows.select("doc_id", "row", F.explode_outer("every").alias("found")).select("doc_id", "row", "found.*")
    passed = W.partitionBy("row", "source").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("hit")).over(passed)
    kinds = F.array(*[F.lit(s.kind) for s in SOURCES])
    bases = F.array(*[F.lit(s.base) for s in SOURCES])
    rows = rows.select(
        "doc_id", "row", F.get(kinds, F.col("source")).alias("kind"), F.get(bases, F.col("source")).alias("base"),
        (end - F.length("hit")).cast("long").alias("start"), end.cast("long").alias("end"), "hit", "before", "after",
    )
    rows = rows.withColumn("valid", strict(F.col("kind"), F.col("hit")))
    vote = votes(*[F.col(c) for c in ("kind", "hit", "before", "after", "base", "valid")])
    return rows.select(
        "doc_id", "row", "kind", "start", "end", (F.col("base") & F.col("valid")).alias("base"),
        F.when(F.col("kind").isNotNull(), vote).alias("votes"),
        F.when(F.col("kind").isNotNull(), features(F.col("hit"))).alias("features"),
    )


def probabilities(found: DataFrame) -> Column:
    """Probability that a candidate is personal data: EM over the votes, then the trained classifier."""
    table = found.where(F.col("kind").isNotNull())
    counted = table.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # 4 x 3 ** 5 rows at most
    models, soft = {}, []
    for kind in KINDS:
        rows = sorted((r["votes"], r["n"]) for r in counted if r["kind"] == kind)
        models[kind] = reliabilities(rows)
        soft += [(kind + v, posterior(v, *models[kind])) for v, _ in rows]
    if not soft:
        return F.lit(0.0)
    chance = F.create_map(*[F.lit(x) for pair in soft for x in pair])
    believed = F.element_at(chance, F.concat("kind", "votes"))
    each = table.select("kind", believed.alias("p"), F.posexplode("features").alias("feature", "value"))
    sums = each.groupBy("kind", "feature", "value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    learnt = {(r["kind"], r["feature"], r["value"]): (r["yes"], r["no"]) for r in sums.collect()}  # kinds x FEATURES
    odds = F.log(believed / (1 - believed))
    for number, width in enumerate(FEATURES):
        values = []
        for kind in KINDS:
            own = [learnt.get((kind, number, v), (0.0, 0.0)) for v in range(width)]
            yes, no = sum(y for y, _ in own) + width, sum(n for _, n in own) + width
            values += [math.log((y + 1) / yes) - math.log((n + 1) / no) for y, n in own]
        place = by_kind(F.col("kind"), {k: F.lit(i * width) for i, k in enumerate(KINDS)})
        odds = odds + F.get(F.array(*map(F.lit, values)), place + F.get("features", F.lit(number)))
    return 1 / (1 + F.exp(-odds))


def spans(docs: DataFrame, least: float = 0.9, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; ``spans`` lists (start, order, kind, end, base, probability) by place.

    Places count code points, ends are exclusive, ``order`` is the kind's place in ``KINDS``.
    Null, empty and blank texts have no spans; null ids are kept; repeated rows are
    searched each; other columns are ignored; an empty table gives no rows.
    """
    found = stored(candidates(docs, doc_id, text), "pii")
    found = found.withColumn("probability", probabilities(found))
    # an added span gives way to base spans, and to added ones before it
    ahead = W.partitionBy("row").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    behind = W.partitionBy("row").orderBy("start", "end").rowsBetween(1, W.unboundedFollowing)
    good = F.col("base") | (F.col("probability") >= least)
    found = found.withColumn("good", F.coalesce(good, F.lit(False)))
    free = F.coalesce(F.max(F.when(F.col("good"), F.col("end"))).over(ahead) <= F.col("start"), F.lit(True))
    free = free & F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(behind) >= F.col("end"), F.lit(True))
    found = found.withColumn("kept", F.col("base") | (F.col("good") & free))
    order = by_kind(F.col("kind"), {k: F.lit(i) for i, k in enumerate(KINDS)})
    span = F.struct("start", order.alias("order"), "kind", "end", "base", "probability")
    listed = F.sort_array(F.collect_list(F.when(F.col("kept"), span)))
    return found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), listed.alias("spans")).select("doc_id", "spans")


def joined(spans_column: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text, per document."""
    base = F.filter("spans", lambda s: s["base"])
    counts = [_count(base, kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def _count(base: Column, kind: str) -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
