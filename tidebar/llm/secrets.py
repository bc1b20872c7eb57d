"""Secret scans with a trigram inverted index, in DataFrame functions alone.

From each rule's regular expression a Boolean query is derived: a list of
alternatives, each of them trigrams that every match must hold (in lower
case). The index has a posting (trigram, doc_id) for each trigram that some
query asks for; postings of an alternative are intersected by document, and
only documents that pass are searched with the rule. A rule without mandatory
trigrams searches all documents.

A null text counts as empty and has no secret. Rows that repeat give the same
spans each, also under one doc_id; a null doc_id is an id like any other here. The
cost is in proportion to a text and its matches, however long and dense it is.
Of matches that start together the kind that is listed first comes first. No
rows give none; columns of any other name stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

try:  # the standard library's parse of a pattern
    from re import _constants as sre, _parser as parser
except ImportError:  # pragma: no cover
    import sre_constants as sre
    import sre_parse as parser

#: Alternatives of a query, at most; a pattern with more is cut into parts that must all match.
MOST_ALTERNATIVES = 32


@dataclass(frozen=True)
class Rule:
    """Matches of pattern count if the group has so many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds, in the order in which spans that start together are listed.
# hex: a run of 24 or more is what remains of [0-9a-f]+ once shorter runs are dropped.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further kinds, which only add spans.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams (lower case), one of which every match holds in full; [] if none is mandatory."""
    parts: list[set[frozenset[str]]] = []

    def trigrams(s: str) -> frozenset[str]:
        return frozenset(s[i : i + 3] for i in range(len(s) - 2))

    def flush(strings: set[str]) -> set[str]:
        if all(len(s) >= 3 for s in strings):
            parts.append({trigrams(s) for s in strings})
        return {""}

    def exact(tree) -> set[str] | None:
        """All strings that the tree can match, in lower case, or None if they are too many."""
        out = {""}
        for op, arg in tree:
            if op is sre.LITERAL:
                more = {chr(arg).lower()}
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
                more = {chr(a).lower() for _, a in arg}
            elif op is sre.SUBPATTERN:
                more = exact(arg[3])
            elif op is sre.BRANCH:
                each = [exact(x) for x in arg[1]]
                more = None if None in each else set().union(*each)
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == 0 and arg[1] == 1 and (inner := exact(arg[2])):
                more = {"", *inner}
            else:
                more = None
            if more is None or len(out) * len(more) > MOST_ALTERNATIVES:
                return None
            out = {a + b for a, b in product(out, more)}
        return out

    now = {""}
    for item in parser.parse(pattern):
        strings = exact([item])
        if strings is None:
            now = flush(now)
        else:
            if len(now) * len(strings) > MOST_ALTERNATIVES:
                now = flush(now)
            now = {a + b for a, b in product(now, strings)}
    flush(now)
    best = min(parts, key=lambda p: (len(p), -min(map(len, p))), default=set())
    alternatives = {a for a in best if not any(b < a for b in best)}
    return sorted(alternatives, key=sorted)


def postings(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """(trigram, doc_id, hash of the text): the inverted index, for the given trigrams of the lower-case texts."""
    wanted = F.array(*map(F.lit, trigrams))
    # the text is put in lower case once a row, as a variable of transform()
    there = F.flatten(F.transform(F.array(F.lower(F.col(text))), lambda low: F.filter(wanted, lambda t: F.contains(low, t))))
    return docs.select(F.explode(there).alias("trigram"), "doc_id", F.xxhash64(F.col(text)).alias("hash"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """(doc_id, hash, rules): a bit for each rule whose query the document passes; documents that pass none are left out.

    A document is known by its id and the hash of its text, so that the rows of an id that repeats stay apart.
    """
    queries = [(1 << n, m, t, 1 << k, (1 << len(a)) - 1) for n, r in enumerate(rules) for m, a in enumerate(trigram_query(r.pattern)) for k, t in enumerate(sorted(a))]
    names = ("rule", "alternative", "trigram", "bit", "full")
    spark = docs.sparkSession
    rows = F.array(*(F.struct(*(F.lit(v).cast("string" if n == "trigram" else "long").alias(n) for n, v in zip(names, q))) for q in queries))
    plan = spark.range(1).select(F.inline(rows))  # as large as the rules, not the data
    met = (
        postings(docs, sorted({q[2] for q in queries}), text)
        .join(F.broadcast(plan), "trigram")
        .groupBy("doc_id", "hash", "rule", "alternative", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = full")
    )
    return met.groupBy("doc_id", "hash").agg(F.bit_or("rule").alias("rules"))


#: Numbers that are summed up at a time: an array that grows by one is copied each time, so that it has to stay short.
CHUNK = 512


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once a row, as a variable of transform()."""
    return F.transform(F.array(value), use)[0]


def running(numbers: Column, op: Callable[[Column, Column], Column]) -> Column:
    """What an array of ints adds up to at each of its places, by op: a sum or a maximum, with 0 as its zero.

    By chunks, and over the chunks' totals, so that what is copied for n numbers is n CHUNK + (n / CHUNK)^2.
    """
    step = lambda acc, v: F.struct(op(acc["now"], v).alias("now"), F.concat(acc["all"], F.array(op(acc["now"], v))).alias("all"))
    zero = F.struct(F.lit(0).alias("now"), F.expr("cast(array() as array<int>)").alias("all"))
    plain = lambda part: F.aggregate(part, zero, step, lambda acc: acc["all"])

    def chunked(x: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), (F.size(x) / CHUNK).cast("int")), lambda c: c * CHUNK < F.size(x))
        return F.transform(starts, lambda c: plain(F.slice(x, c * CHUNK + 1, F.lit(CHUNK))))

    def joined(chunks: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), plain(F.transform(chunks, lambda c: F.element_at(c, -1))))
        return F.flatten(F.zip_with(chunks, F.slice(before, F.lit(1), F.size(chunks)), lambda c, b: F.transform(c, lambda v: op(b, v))))

    return bound(numbers, lambda x: bound(chunked(x), joined))


def _matches(rule: Rule, order: int, text: Column, length: Callable[[Column], Column]) -> Column:
    """array<struct<start, kind, end>> of the rule's matches, in code points (or bytes, by length)."""
    pattern = F.lit(rule.pattern)
    sizes = lambda group: F.transform(F.regexp_extract_all(text, pattern, F.lit(group)), length)
    counted = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    between = F.transform(F.split(text, rule.pattern, -1), length)

    def placed(whole: Column) -> Column:
        ends = running(F.zip_with(F.slice(between, F.lit(1), F.size(whole)), whole, lambda gap, size: gap + size), lambda a, b: a + b)
        spans = F.zip_with(ends, whole, lambda end, size: F.struct((end - size).alias("start"), F.lit(order).alias("kind"), end.alias("end")))
        kept = F.zip_with(spans, counted, lambda span, n: F.when(n >= rule.least, span))
        return F.array_compact(kept)

    return bound(sizes(0), placed)


#: No span at all.
_NONE = "cast(array() as array<struct<start:int,kind:int,end:int>>)"


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", name: str = "spans", length: Callable[[Column], Column] = F.char_length) -> DataFrame:
    """docs with a column (`spans`): array<struct<start, kind, end>>, sorted; kind is the rule's number.

    Other columns stay, except one that has this name already. Places count code points, or bytes with F.octet_length.
    """
    columns = [c for c in docs.columns if c != name]
    chosen = candidates(docs, rules, text).select(F.col("doc_id").alias("_secret_id"), F.col("hash").alias("_secret_hash"), F.col("rules").alias("_secret_rules"))
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    found = []
    for n, rule in enumerate(rules):
        passes = F.getbit(F.coalesce(chosen["_secret_rules"], F.lit(0).cast("long")), F.lit(n)) == 1 if trigram_query(rule.pattern) else body.rlike(rule.pattern)
        found.append(F.when(passes, _matches(rule, n, body, length)).otherwise(F.expr(_NONE)))
    same = docs["doc_id"].eqNullSafe(chosen["_secret_id"]) & (F.xxhash64(docs[f"`{text}`"]) == chosen["_secret_hash"])
    joined = docs.join(chosen, same, "left")
    return joined.select(*(docs[f"`{c}`"] for c in columns), F.array_sort(F.concat(*found)).alias(name))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans for each row of docs."""
    spans = F.col("spans")
    count = lambda n: F.size(F.filter(spans, lambda s: s["kind"] == n)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    return with_spans(docs.select("doc_id", "text")).select(
        "doc_id",
        *(count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with each secret in text replaced by mark, and n_chars counted anew where one was; same columns and rows.

    Spans that overlap are one mark. Pieces are cut from the text's bytes, as a cut of characters would walk the text
    from its start each time.
    """
    body = F.col("text")

    def masked(spans: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), running(F.transform(spans, lambda s: s["end"]), F.greatest))  # one more than spans: the rest of the text
        both = F.zip_with(spans, before, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at")))
        pieces = F.filter(both, lambda x: x["start"].isNull() | (x["start"] >= x["at"]))
        piece = lambda raw, x: F.substring(raw, x["at"] + 1, F.coalesce(x["start"], F.octet_length(raw)) - x["at"]).cast("string")
        return bound(body.cast("binary"), lambda raw: F.array_join(F.transform(pieces, lambda x: piece(raw, x)), mark))

    name = fresh(docs, "_secret_spans")
    some = F.size(name) > 0
    out = with_spans(docs, name=name, length=F.octet_length).withColumn("text", F.when(some, bound(F.col(name), masked)).otherwise(body))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(some, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def compiled(rule: Rule) -> re.Pattern:
    """The rule for Python, as tests use it."""
    return re.compile(rule.pattern)
