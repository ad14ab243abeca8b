"""Personal data by weak supervision, with DataFrame functions only.

1. Patterns find candidates in every text: the base patterns with their failing matches (a card whose
   checksum is wrong, an address part above 255) and looser forms. Positions come from the lengths of
   the matches and of the texts between them.
2. Labelers vote on each candidate: for, against, or not at all. They look at the form (regex), at
   its validity, at short lists of known prefixes and endings (gazetteer), at the words before it
   (context), and at the characters around it.
3. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is
   per kind, and how likely each pattern is personal data. Patterns are bounded by the labelers.
4. The likelihoods are soft labels for the span classifier: log-odds of span features, summed. It
   accepts further spans; spans of the base rules always stay.

Everything per document happens in its row; only counts are shuffled.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import written

KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
# The base patterns, written so that a long run of matching characters is tried once. A run can only
# match from its start, or from where the match before it ended.
PATTERNS = (
    ("email", "base", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++", lambda t: F.instr(t, "@") > 0),
    ("ip", "base", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]")),
    ("card", "base", r"[0-9](?:[ -]?[0-9])++", lambda t: t.rlike(r"[0-9][ -]?[0-9]")),
    ("phone", "base", r"\+[0-9][ ().0-9-]+[0-9]", lambda t: F.instr(t, "+") > 0),
    (
        "email",
        "loose",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++ ?[\[(]at[\])] ?{LABEL}++(?: ?(?:[\[(]dot[\])]|\.) ?{LABEL}++)++",
        lambda t: (F.instr(t, "(at)") > 0) | (F.instr(t, "[at]") > 0),
    ),
    (
        "email",
        "loose",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++ at {LABEL}++(?: dot {LABEL}++)++",
        lambda t: (F.instr(t, " at ") > 0) & (F.instr(t, " dot ") > 0),
    ),
    (
        "ip",
        "loose",
        r"(?<![0-9.])[0-9]{1,3}(?:(?: ?[\[(](?:\.|dot)[\])] ?| \. )[0-9]{1,3}){3}(?![0-9.])",
        lambda t: t.rlike(r"[0-9] ?[\[( ](?:\.|dot)[\]) ] ?[0-9]"),
    ),
    (
        "phone",
        "loose",
        r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
        lambda t: t.rlike(r"[0-9]{3}[ .-][0-9]{4}"),
    ),
    (
        "phone",
        "loose",
        r"(?<![0-9A-Za-z+.-])0[0-9]{1,4}[ /-][0-9]{3,4}(?:[ -][0-9]{2,4}){1,3}(?![0-9A-Za-z])",
        lambda t: t.rlike(r"0[0-9]{1,4}[ /-][0-9]{3}"),
    ),
)
BLOCK = 64
CHUNK = 4096
WORD_SLOTS = 64
LABELERS = ("form", "valid", "gazetteer", "context", "border")
# fixed values: endings of addresses, prefixes of cards and of telephone numbers, telling words
ENDINGS = r"(?i)\.(com|org|net|edu|gov|int|info|biz|io|co|de|fr|es|it|nl|uk|us|ca|ch|at|be|eu)$"
CARD_PREFIXES = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
PHONE_PREFIXES = r"^(1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CONTEXT = {
    "email": (r"(?i)(mail|contact|write|reach)", r"(?i)(example of|pattern|regex)"),
    "ip": (r"(?i)(\bip\b|address|host|server|from)", r"(?i)(version|release|\bv\.?|section|chapter)\W*$"),
    "card": (r"(?i)(card|visa|master|amex|credit|pay|account)", r"(?i)(isbn|order|invoice|serial|\bid|hash|token|key)\W*$"),
    "phone": (r"(?i)(phone|tel|call|fax|mobile|reach)", r"(?i)(version|order|invoice|serial|\bid)\W*$"),
}
SPAN = "struct<start:int,end:int,match:string,before:string,after:string>"


@dataclass(frozen=True)
class PiiModel:
    """What was learned: reliabilities of the labelers, and log-odds of the span features."""

    reliabilities: dict[tuple[str, str, int], tuple[float, float]]
    weights: dict[str, float]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not wherever it is used."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, first: Column, step) -> Column:
    """``first``, then what ``step`` makes of it with one value after the other; one more entry than values.

    Arrays grow in blocks of about the square root of their length, so a long array is not copied for each entry.
    ``step`` must be associative, with ``first`` as its neutral value.
    """

    def grown(part: Column, start: Column) -> Column:
        return F.aggregate(part, F.array(start), lambda done, v: F.concat(done, F.array(step(F.element_at(done, -1), v))))

    def blocked(all_: Column) -> Column:
        size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(all_))).cast("int"))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / size).cast("int")), lambda b: F.slice(all_, b * size + 1, size))

        def joined(parts: Column) -> Column:
            totals = F.transform(parts, lambda part: F.aggregate(part, first, step))
            return let(
                grown(totals, first),
                lambda before: F.concat(
                    F.array(first),
                    F.flatten(F.transform(parts, lambda part, b: let(grown(part, before[b]), lambda g: F.slice(g, 2, F.size(part))))),
                ),
            )

        return let(blocks, joined)

    return let(values, lambda all_: F.when(F.size(all_) <= BLOCK, grown(all_, first)).otherwise(blocked(all_)))


def occurrences(text: Column, pattern: str, there: Column) -> Column:
    """Leftmost matches that do not overlap, with positions in code points and what surrounds them."""
    def spans(found: Column) -> Column:
        matches, gaps = found["matches"], found["gaps"]
        steps = F.transform(matches, lambda m, i: F.length(gaps[i]) + F.length(m))

        def placed(ends: Column) -> Column:
            return F.transform(
                matches,
                lambda m, i: F.struct(
                    (ends[i] + F.length(gaps[i])).alias("start"),
                    ends[i + 1].alias("end"),
                    m.alias("match"),
                    F.right(gaps[i], F.lit(40)).alias("before"),
                    F.substring(gaps[i + 1], 1, 16).alias("after"),
                ),
            )

        return let(running(steps, F.lit(0), lambda a, b: a + b), placed)

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("gaps")
    )
    empty = F.array().cast(f"array<{SPAN}>")
    return F.when(there, let(both, lambda b: F.when(F.size(b["matches"]) > 0, spans(b)).otherwise(empty))).otherwise(empty)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a digit string is right."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(
            F.coalesce(c.cast("int"), F.lit(0))
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def small_parts(match: Column) -> Column:
    """Whether all four parts of an address are at most 255."""

    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        number = F.concat(F.lit("0"), F.when(F.length(bare) <= 3, bare)).cast("int")
        return F.coalesce(number <= 255, F.lit(False))

    return F.forall(F.split(match, r"\."), small)


def is_base(kind: str, match: Column) -> Column:
    digits = digits_of(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return small_parts(match)
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    return F.length(digits).between(8, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def shape(part: Column) -> Column:
    """Letters as a, digits as 0, other characters as they are."""
    return F.regexp_replace(F.regexp_replace(part, "[A-Za-z]", "a"), "[0-9]", "0")


def candidate(kind: str, form: str, span: Column) -> Column:
    """A found span with its votes and features; ``base`` tells whether the base rules accept it."""
    match, before, after = span["match"], span["before"], span["after"]
    digits = digits_of(match)
    base = is_base(kind, match) if form == "base" else F.lit(False)
    if kind == "email":
        valid = _vote(match.rlike(r"[\])@ .][A-Za-z]{2,}$"), match.rlike(r"[0-9-]$"))
        known = _vote(match.rlike(ENDINGS), F.lit(False))
    elif kind == "ip":
        valid = _vote(base, ~base)
        known = _vote(~match.rlike(r"^0") & base, match.rlike(r"^(0|00|000)\."))
    elif kind == "card":
        right = F.length(digits).between(13, 19) & luhn(digits)
        valid = _vote(right, ~right)
        known = _vote(digits.rlike(CARD_PREFIXES) & F.length(digits).between(13, 19), F.length(digits) < 12)
    else:
        right = F.length(digits).between(8, 15)
        valid = _vote(right, ~right)
        known = _vote(digits.rlike(PHONE_PREFIXES) & right, digits.rlike("^0000"))
    good, bad = CONTEXT[kind]
    tight = before.rlike(r"[A-Za-z0-9_=\"'/.-]$") | after.rlike(r"^[A-Za-z0-9_=\"'/]|^[.-][A-Za-z0-9]")
    votes = {
        "form": _vote(base, F.lit(form == "base") & ~base),
        "valid": valid,
        "gazetteer": known,
        "context": _vote(before.rlike(good), before.rlike(bad)),
        "border": _vote(~tight, tight),
    }
    size = F.least(F.floor(F.length(match) / 4), F.lit(9))
    marks = F.least(F.length(match) - F.length(F.regexp_replace(match, "[ ().@\\[\\]-]", "")), F.lit(6))
    features = [
        F.concat(F.lit(f"{kind}|size|"), size.cast("string")),
        F.concat(F.lit(f"{kind}|marks|"), marks.cast("string")),
        F.concat(F.lit(f"{kind}|digits|"), F.least(F.length(digits), F.lit(20)).cast("string")),
        *(F.concat(F.lit(f"{kind}|{n}|"), votes[n].cast("string")) for n in LABELERS),
        # what no labeler looks at: the shape of both ends, and the word before
        F.concat(F.lit(f"{kind}|begins|"), shape(F.substring(match, 1, 3))),
        F.concat(F.lit(f"{kind}|ends|"), shape(F.right(match, F.lit(3)))),
        F.concat(F.lit(f"{kind}|word|"), F.pmod(F.xxhash64(F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))), F.lit(WORD_SLOTS)).cast("string")),
    ]
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        base.alias("base"),
        F.concat(F.lit(f"{kind}:"), *(votes[n].cast("string") for n in LABELERS)).alias("pattern"),
        F.array(*features).alias("features"),
    )


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_found``, the candidates of every kind in every whole text (null: none)."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.select("*", *(occurrences(whole, p, there(whole)).alias(f"_span{i}") for i, (_, _, p, there) in enumerate(PATTERNS)))

    def judged(kind: str, form: str):
        return lambda span: candidate(kind, form, span)

    parts = [F.transform(f"_span{i}", judged(kind, form)) for i, (kind, form, _, _) in enumerate(PATTERNS)]
    return found.withColumn("_found", F.concat(*parts)).drop(*(f"_span{i}" for i in range(len(PATTERNS))))


def _maximise(patterns: dict[str, int], rounds: int = 40) -> tuple[dict, dict[str, float]]:
    """Reliabilities per kind, labeler and vote, and the likelihood of each vote pattern.

    ``patterns`` has counts by ``kind:votes``. Prior counts hold the labelers to being right more
    often than not, so that the two sides cannot change places.
    """
    reliable: dict[tuple[str, str, int], tuple[float, float]] = {}
    likely: dict[str, float] = {}
    prior = {1: (6.0, 1.5), 0: (4.0, 4.0), -1: (1.5, 6.0)}
    for kind in KINDS:
        rows = []
        for pattern, n in patterns.items():
            name, _, votes = pattern.partition(":")
            if name == kind:
                signs = [int(v) for v in re.findall(r"-?[01]", votes)]
                rows.append((pattern, signs, n))
        share = 0.5
        table = {(i, v): (prior[v][0] / 11.5, prior[v][1] / 11.5) for i in range(len(LABELERS)) for v in (-1, 0, 1)}
        for _ in range(rounds):
            sums = {key: list(prior[key[1]]) for key in table}
            yes = 1.0
            total = 2.0
            for pattern, signs, n in rows:
                odds = math.log(share / (1 - share)) + sum(math.log(table[i, v][0] / table[i, v][1]) for i, v in enumerate(signs))
                p = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
                likely[pattern] = p
                yes += n * p
                total += n
                for i, v in enumerate(signs):
                    sums[i, v][0] += n * p
                    sums[i, v][1] += n * (1 - p)
            share = min(max(yes / total, 1e-6), 1 - 1e-6)
            for i in range(len(LABELERS)):
                for side in (0, 1):
                    whole = sum(sums[i, v][side] for v in (-1, 0, 1))
                    for v in (-1, 0, 1):
                        sums[i, v][side] /= whole
            table = {key: (value[0], value[1]) for key, value in sums.items()}
        reliable |= {(kind, LABELERS[i], v): pair for (i, v), pair in table.items()}
    return reliable, likely


def _lookup(table: dict[str, float], key: Column, missing: float) -> Column:
    if not table:
        return F.lit(missing)
    entries = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(F.try_element_at(entries, key), F.lit(missing))


def fit(found: DataFrame) -> PiiModel:
    """Learn from all candidates of a table that has ``_found``.

    The driver gets counts of vote patterns (at most 4 kinds of 3**5) and of feature values.
    """
    spans = found.select(F.explode("_found").alias("s")).select("s.pattern", "s.features")
    patterns = {r.pattern: r.n for r in spans.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    reliable, likely = _maximise(patterns)
    soft = spans.withColumn("p", _lookup(likely, F.col("pattern"), 0.5)).select(F.explode("features").alias("feature"), "p")
    sums = soft.groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    sides: dict[str, list[float]] = {}
    for r in sums:
        side = sides.setdefault(r.feature.rpartition("|")[0], [0.0, 0.0])
        side[0] += r.yes
        side[1] += r.no
    weights = {}
    for r in sums:
        yes, no = sides[r.feature.rpartition("|")[0]]
        weights[r.feature] = math.log((r.yes + 0.5) / (yes + 5)) - math.log((r.no + 0.5) / (no + 5))
    for kind in KINDS:
        yes, no = sides.get(f"{kind}|size", (0.0, 0.0))
        weights[f"{kind}|prior"] = math.log((yes + 1) / (no + 1))
    return PiiModel(reliable, weights)


def span_columns(model: PiiModel) -> tuple[Column, Column]:
    """Base spans and all spans of a row as sorted arrays of (kind, start, end), from ``_found``."""

    def plain(s: Column) -> Column:
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    def score(s: Column) -> Column:
        prior = _lookup({str(i): model.weights.get(f"{k}|prior", 0.0) for i, k in enumerate(KINDS)}, s["kind"].cast("string"), 0.0)
        return F.aggregate(s["features"], prior, lambda total, f: total + _lookup(model.weights, f, 0.0))

    base = F.array_sort(F.transform(F.filter("_found", lambda s: s["base"]), plain))
    more = F.transform(F.filter("_found", lambda s: ~s["base"] & (score(s) > 0)), plain)
    return base, more


def overlapped(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``.

    Among the others that start before a span ends, the furthest end tells; where they stop is found by halving.
    """

    def apart(sorted_: Column) -> Column:
        def judged(reach: Column) -> Column:
            rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_) + 1)).cast("int") + 1)

            def free(s: Column) -> Column:
                # how many of the others start before this span ends
                start = F.struct(F.lit(0).alias("low"), F.size(sorted_).alias("high"))

                def halve(state: Column, _: Column) -> Column:
                    middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
                    before = (state["low"] < state["high"]) & (F.get(sorted_, middle)["start"] < s["end"])
                    low = F.when(before, middle + 1).otherwise(state["low"])
                    high = F.when(before, state["high"]).otherwise(F.least(middle, state["high"]))
                    return F.struct(low.alias("low"), high.alias("high"))

                return F.aggregate(rounds, start, halve, lambda state: reach[state["low"]] <= s["start"])

            return F.filter(spans, free)

        return let(running(F.transform(sorted_, lambda o: o["end"]), F.lit(0), lambda a, b: F.greatest(a, b)), judged)

    by_start = F.array_sort(F.transform(others, lambda o: F.struct(o["start"].alias("start"), o["end"].alias("end"))))
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(by_start, apart))


def with_spans(found: DataFrame, model: PiiModel) -> DataFrame:
    """Adds ``_base`` and ``_spans``; a further span that overlaps a base span is left out."""
    base, more = span_columns(model)

    def judged(both: Column) -> Column:
        free = overlapped(both["more"], both["base"])
        return F.struct(
            both["base"].alias("base"),
            F.when(F.size(both["more"]) == 0, both["base"])
            .otherwise(F.array_sort(F.array_distinct(F.concat(both["base"], free))))
            .alias("spans"),
        )

    rows = found.withColumn("_both", let(F.struct(base.alias("base"), more.alias("more")), judged))
    return rows.withColumn("_base", F.col("_both")["base"]).withColumn("_spans", F.col("_both")["spans"]).drop("_both")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id n_email n_ip n_card n_phone base_sha256 spans`` per row of ``docs``.

    Counts and the digest are of the base spans. ``docs`` needs ``doc_id`` and ``text``; other columns are
    ignored. A null or empty text has no spans. Repeated rows and rows without an id are rows of their
    own. An empty table gives an empty one; without candidates only base spans can be found.
    """
    found = written(with_candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"))
    rows = with_spans(found, fit(found))
    def number_of(kind: int) -> Column:
        return F.size(F.filter("_base", lambda span: span["kind"] == kind)).cast("long")

    counts = [number_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(span_text(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets.

    The model is learned in a first pass over all rows. Spans that overlap are one range, from the least
    start to the greatest end, of the kind that starts first (the longest of those). Texts without spans,
    null ones included, stay as they are; so do all other columns.
    """
    own = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[text].cast("string").alias("text"))
    found = written(with_candidates(own.select("text")).select("_found").filter(F.size("_found") > 0))
    model = fit(found)
    rows = with_spans(with_candidates(own), model)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    in_order = F.array_sort(
        F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"), s["end"].alias("end")))
    )
    text_ = F.col("text")

    def between(chunks: Column, a: Column, b: Column) -> Column:
        """Code points from ``a`` to ``b``, read off the chunks that hold them."""
        first, last = F.floor(a / CHUNK).cast("int"), F.floor(b / CHUNK).cast("int")
        head = F.coalesce(F.get(chunks, first), F.lit(""))
        tail = F.coalesce(F.get(chunks, last), F.lit(""))
        near = F.substring(head, a - first * CHUNK + 1, b - a)
        far = F.concat(
            F.substring(head, a - first * CHUNK + 1, F.lit(CHUNK)),
            F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.substring(tail, F.lit(1), b - last * CHUNK),
        )
        return F.when(first == last, near).otherwise(far)

    def ranges(spans: Column) -> Column:
        """Spans that overlap as one, of the kind of the first."""

        def merged(reach: Column) -> Column:
            begins = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (spans[i]["start"] >= reach[i]))
            return let(
                begins,
                lambda firsts: F.transform(
                    firsts,
                    lambda i, k: F.struct(
                        spans[i]["start"].alias("start"),
                        reach[F.coalesce(F.get(firsts, k + 1), F.size(spans))].alias("end"),
                        spans[i]["kind"].alias("kind"),
                    ),
                ),
            )

        return let(running(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b)), merged)

    def rebuilt(state: Column) -> Column:
        found, chunks = state["ranges"], state["chunks"]

        def part(r: Column, k: Column) -> Column:
            before = F.coalesce(F.get(found, k - 1)["end"], F.lit(0))
            return F.concat(between(chunks, before, r["start"]), F.element_at(names, r["kind"] + 1))

        rest = between(chunks, F.element_at(found, -1)["end"], F.length(text_))
        return F.concat(F.array_join(F.transform(found, part), ""), rest)

    state = F.struct(
        let(in_order, ranges).alias("ranges"),
        F.regexp_extract_all(text_, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"),
    )
    clean = F.when(F.size("_spans") > 0, let(state, rebuilt)).otherwise(text_)
    return rows.select(*(clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
