"""Secrets in texts, found through an inverted index of trigrams (DataFrame
and SQL only).

Each rule is a regular expression. ``trigram_query`` derives from it, with
Python's own regex parser, a Boolean query that every text with a match must
satisfy: a set of alternatives, each a set of trigrams that all occur. The
index holds postings (trigram, document) of the trigrams that any query
names. Postings are intersected per alternative by counting a document's
distinct trigrams of it; the union over the alternatives gives a rule's
candidates. Candidates are verified by the rule itself over the whole text.
A rule without a mandatory trigram scans every text.

Trigrams are compared after lower-casing A-Z, so that rules that ignore case
can be indexed; that only widens the candidates.

Defined results: a null text is empty and has no span. Spans are in code
points, end exclusive. A null id is an id of its own. Rows that share an id
are each judged by their own text. Empty tables give no rows.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, own_columns


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters, else the match is dropped."""
    kind: str
    pattern: str
    group: int
    least: int


# The base rules of the scan, in the order of their listing.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# Rules that this scan adds.
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9+/_.=-]+", 0, 27),
)
RULES = BASE_RULES + ADDED_RULES

MOST_STRINGS = 64  # literal variants kept while a query is derived


def _query(strings: set[str]) -> set[frozenset[str]] | None:
    """One of ``strings`` occurs: an alternative per string, the trigrams of
    it. None if a string is too short to have one."""
    grams = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    return grams if grams and all(grams) else None


def _sharpest(queries: list[set[frozenset[str]]]) -> set[frozenset[str]] | None:
    """Of conditions that all hold, the one whose weakest alternative names
    most trigrams."""
    return max(queries, key=lambda q: min(len(a) for a in q)) if queries else None


def _derive(parsed) -> tuple[set[str] | None, list[set[frozenset[str]]]]:
    """(every string the expression can be, None if not few; conditions that
    hold wherever it matches)."""
    run: set[str] = {""}     # what the known parts next to each other can be
    whole, must = True, []

    def close():
        nonlocal run
        if query := _query(run):
            must.append(query)
        run = {""}

    for op, arg in parsed:
        options, inner = None, []
        if op is sre.LITERAL:
            options = {chr(arg).lower()}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            options = {chr(c).lower() for _, c in arg}
        elif op is sre.SUBPATTERN:
            options, inner = _derive(arg[3])
        elif op is sre.BRANCH:
            sides = [_derive(side) for side in arg[1]]
            if all(s[0] is not None for s in sides):
                options = set().union(*(s[0] for s in sides))
            elif all(best := [_sharpest(s[1] + [q for q in [_query(s[0] or {""})] if q]) for s in sides]):
                inner = [set().union(*best)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = arg
            strings, conditions = _derive(body)
            if least == 0 and most == 1 and strings is not None:
                options = strings | {""}
            elif least > 0:
                inner = conditions + [q for q in [_query(strings or {""})] if q]
        if options is None:
            whole = False
            close()
            must.extend(inner)
        elif len(options) * len(run) > MOST_STRINGS:
            whole = False
            close()
            run = options
        else:
            run = {a + b for a, b in itertools.product(run, options)}
    if whole:
        return run, must
    close()
    return None, must


def trigram_query(pattern: str) -> set[frozenset[str]] | None:
    """Alternatives, each a set of trigrams that must all occur; None if no
    trigram is mandatory. Of several conditions the most selective stays."""
    strings, must = _derive(_parser.parse(pattern))
    query = _sharpest(must + [q for q in [_query(strings or {""})] if q])
    # an alternative that asks for more than another adds nothing
    return query and {a for a in query if not any(b < a for b in query)}


def postings(docs: DataFrame, rules=RULES) -> DataFrame:
    """(gram, doc_id): the inverted index over the trigrams that queries name."""
    grams = sorted({g for r in rules for a in trigram_query(r.pattern) or () for g in a})
    low = docs.select("doc_id", ascii_lower(F.col("text")).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("doc_id", F.explode(held).alias("gram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose Boolean query a document satisfies."""
    spark = index.sparkSession
    clauses = [(r.kind, f"{r.kind}{n}", len(a), g) for r in rules
               for n, a in enumerate(sorted(trigram_query(r.pattern) or (), key=sorted)) for g in sorted(a)]
    if not clauses:
        return index.select("doc_id", F.array().cast("array<string>").alias("kinds")).limit(0)
    # a row per rule, alternative and trigram: as many as the patterns have
    named = F.broadcast(spark.createDataFrame(clauses, "kind string, clause string, needs int, gram string"))
    return (index.join(named, "gram").groupBy("doc_id", "kind", "clause", "needs")
            .agg(F.count_distinct("gram").alias("n")).filter("n = needs")
            .groupBy("doc_id").agg(F.collect_set("kind").alias("kinds")))


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, kind_no, end>> of a rule's matches in ``text``."""
    whole = F.lit(f"({rule.pattern})")
    pieces = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, whole, F.lit(1))
    group = F.regexp_extract_all(text, whole, F.lit(rule.group + 1))
    cuts = F.zip_with(F.slice(pieces, 1, F.size(found)), F.zip_with(found, group, lambda m, g: F.struct(
        F.length(m).alias("m"), F.length(g).alias("g"))), lambda p, x: F.struct(F.length(p).alias("p"), x["m"].alias("m"), x["g"].alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,no:int,end:int>>").alias("out"))
    no = [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)

    def step(acc, x):
        begin = acc["at"] + x["p"]
        span = F.struct(begin.alias("start"), F.lit(no).alias("no"), (begin + x["m"]).alias("end"))
        return F.struct((begin + x["m"]).alias("at"),
                        F.when(x["g"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))
    return F.aggregate(cuts, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, kind
    number in ``rules``, end) by start, then kind."""
    docs = own_columns(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    found = candidates(postings(docs, rules), rules).select(F.col("doc_id").alias("_c"), "kinds")
    judged = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_c")), "left")
    none = F.array().cast("array<struct<start:int,no:int,end:int>>")
    parts = []
    for rule in rules:
        due = F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), rule.kind) \
            if trigram_query(rule.pattern) else F.col("text").rlike(_prefilter(rule))
        parts.append(F.when(due, _spans(F.col("text"), rule)).otherwise(none))
    return judged.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _prefilter(rule: Rule) -> str:
    """For a rule of one repeated character class that scans every text: a
    run of the least length is cheaper to look for than all short runs."""
    m = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{m[1]}{{{rule.least}}}" if m and rule.group == 0 else rule.pattern


def listed(spans: Column, rules=RULES) -> Column:
    """``kind:start:end`` comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
