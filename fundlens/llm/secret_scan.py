"""Secret scans over a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: a document that matches the
pattern must hold the trigrams the query asks for. The index has one posting per document and
trigram that some query names. Postings of a document are intersected by one aggregation, which
leaves candidates per rule; only candidates meet the rule's pattern. Rules without mandatory
trigrams are matched against every text.

Everything is DataFrame functions. Postings are a few bytes each; texts are not shuffled as
long as the candidates are few enough for a size-checked broadcast, and once otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op  # the standard library's own parser reads the patterns
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import lower_ascii, pick, tagged, untagged
from fundlens.operators.joins import small_side


@dataclass(frozen=True)
class Rule:
    """Matches of pattern whose group has min_length characters or more; base rules count in digests.

    `hint`, if given, is a cheaper pattern that is found wherever such a match is.
    """

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0
    any_case: bool = False
    base: bool = False
    hint: str = ""


# The base rules of the contract, then the rules this scan adds.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, min_length=8, any_case=True, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", min_length=16, base=True, hint=r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]+", min_length=32, base=True, hint=r"[0-9a-f]{32}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

# Alternatives of a part of a pattern that are followed one by one.
MAX_STRINGS = 64

# A query is a set of alternatives, each a set of trigrams that must all be there.
Query = frozenset


def _both(a: Query, b: Query) -> Query:
    return frozenset(x | y for x in a for y in b)


def _grams(strings: set[str]) -> Query:
    """What a text with one of the strings in it must hold."""
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


EVERYTHING: Query = frozenset([frozenset()])


def _walk(items, exact: set[str]) -> tuple[Query, set[str]]:
    """Query of what is complete, and the strings the text read so far may end with.

    The strings of a run of literals, small classes and alternatives are followed together;
    anything else ends the run, whose trigrams then are mandatory.
    """
    query = EVERYTHING
    for kind, value in items:
        if kind is op.LITERAL:
            step = {chr(value).lower()}
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            step = {chr(v).lower() for _, v in value}
        elif kind is op.SUBPATTERN:
            part, exact = _walk(value[-1], exact)
            query = _both(query, part)
            continue
        elif kind is op.BRANCH:
            ways = [_walk(branch, exact) for branch in value[1]]
            if all(part == EVERYTHING for part, _ in ways):
                exact = set().union(*(ends for _, ends in ways))
            else:
                query = _both(query, frozenset().union(*(_both(part, _grams(ends)) for part, ends in ways)))
                exact = {""}
            continue
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] == 0 and value[1] == 1:
            part, ends = _walk(value[2], exact)
            if part == EVERYTHING:
                exact = exact | ends
                continue
            step = None
        elif kind is op.AT:
            continue
        else:
            step = None
        if step is None or len(exact) * len(step) > MAX_STRINGS:
            query, exact = _both(query, _grams(exact)), {""}
            if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
                part, ends = _walk(value[2], {""})
                query = _both(query, _both(part, _grams(ends)))
            step = {""} if step is None else step
        exact = {a + b for a, b in product(exact, step)}
    return query, exact


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams, one of which every match holds whole.

    An empty alternative means that nothing is mandatory: the rule must scan fully.
    """
    query, ends = _walk(parser.parse(pattern), {""})
    found = _both(query, _grams(ends))
    return frozenset(a for a in found if not any(b < a for b in found))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, kind, end) of a rule's leftmost non-overlapping matches.

    Matches and the gaps between them alternate, so their lengths give the positions.
    """
    pattern = F.lit(("(?i)" if rule.any_case else "") + rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("match"))), values,
        lambda p, v: F.struct(p["gap"].alias("gap"), p["match"].alias("match"), F.length(v).alias("value")))
    kind = "struct<start:int,order:int,kind:string,end:int>"
    placed = F.aggregate(
        lengths, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("found")),
        lambda state, p: F.struct(
            (state["at"] + p["gap"] + F.coalesce(p["match"], F.lit(0))).alias("at"),
            F.when(p["value"] >= rule.min_length, F.concat(state["found"], F.array(F.struct(
                (state["at"] + p["gap"]).alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"),
                (state["at"] + p["gap"] + p["match"]).alias("end"))))).otherwise(state["found"]).alias("found")))
    hint = F.lit(rule.hint) if rule.hint else pattern
    return F.when(F.regexp_like(text, hint), placed["found"]).otherwise(F.array().cast(f"array<{kind}>"))


def candidates(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The index's answer: key and a bitmap of the rules whose query the text of that key meets.

    rows has key and text; keys without a candidate are absent.
    """
    queries = {i: q for i, r in enumerate(rules) if frozenset() not in (q := trigram_query(r.pattern))}
    grams = sorted(set().union(*(alternative for q in queries.values() for alternative in q)))
    low = lower_ascii(F.col("text"))
    held = F.filter(F.array(*(F.when(F.contains(F.col("low"), F.lit(g)), F.lit(n)) for n, g in enumerate(grams))),
                    lambda n: n.isNotNull())
    postings = rows.select("key", low.alias("low")).select(F.explode(held).alias("gram"), "key")
    word = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("gram") % 62)
    words = [F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, word).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
             for w in range(-(-len(grams) // 62))]
    met = postings.groupBy("key").agg(*words)

    def holds(alternative) -> Column:
        masks = [0] * len(words)
        for g in alternative:
            n = grams.index(g)
            masks[n // 62] |= 1 << n % 62
        parts = [F.col(f"w{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m]
        return reduce(Column.__and__, parts)

    bits = [F.when(reduce(Column.__or__, [holds(a) for a in q]), F.lit(1 << i)).otherwise(F.lit(0)) for i, q in queries.items()]
    return met.select("key", reduce(Column.__add__, bits).alias("rules")).where("rules > 0")


def _found(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """rows (with text and doc_id) plus found: all spans in order."""
    keyed = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn(
        "key", F.xxhash64("doc_id", "text"))  # equal keys share candidates, which only widens them
    hits = small_side(candidates(keyed.select("key", "text"), rules))
    joined = keyed.join(hits.withColumnRenamed("rules", "ruled"), "key", "left")
    full = {i for i, r in enumerate(rules) if frozenset() in trigram_query(r.pattern)}
    spans = []
    for i, rule in enumerate(rules):
        found = _spans(F.col("text"), rule, i)
        if i not in full:
            asked = F.coalesce(F.col("ruled"), F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0
            found = F.when(asked, found).otherwise(F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>"))
        spans.append(found)
    return joined.withColumn("found", F.array_sort(F.flatten(F.array(*spans))))


def _of_kind(kind: str) -> Column:
    return F.filter("found", lambda s: s["kind"] == kind)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, by start, then rule).

    Positions are code points, ends exclusive. A null or empty text has no spans. Null ids and
    repeated rows are scanned like others; an empty table gives no rows; other columns are
    dropped. Rules may overlap: each reports its own spans.
    """
    found = _found(pick(df, doc_id=id_column, text=text_column), rules)
    base = [r.kind for r in rules if r.base]
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(_written(F.filter("found", lambda s: s["kind"].isin(base))).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), _written(F.col("found")).alias("spans"))


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]", id_column: str = "doc_id",
           text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """df with every span replaced by the mask, overlapping spans by one; all columns and rows stay.

    A null text stays null, an empty one empty. length_column, if given, gets the new number of
    characters. Repeated rows and ids, null ids too, are masked row by row; an empty table gives
    no rows. Texts are masked whole at any length.
    """
    found = _found(tagged(df, doc_id=id_column, text=text_column), rules)
    text = F.col("text")
    cut = F.aggregate(
        "found", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda state, s: F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] >= state["at"], F.concat(state["parts"], F.array(
                F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mask)))).otherwise(state["parts"]).alias("parts")))
    rest = F.substring(text, cut["at"] + 1, F.length(text))
    clean = F.when(F.size("found") > 0, F.concat(F.array_join(cut["parts"], ""), rest)).otherwise(text)
    at = df.columns.index(text_column)
    out = found.withColumn("clean", clean).withColumn(f"_{at}", F.when(F.col(f"_{at}").isNotNull(), F.col("clean")))
    if length_column is not None:
        n = df.columns.index(length_column)
        out = out.withColumn(f"_{n}", F.when(F.size("found") > 0, F.length("clean")).otherwise(F.col(f"_{n}")).cast(df.schema[n].dataType))
    return untagged(out, df)
