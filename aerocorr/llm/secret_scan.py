"""Secret scans behind a trigram inverted index.

Every rule is a regular expression.  Its parse tree gives a Boolean trigram
query: an OR of alternatives, each an AND of trigrams that any match must
contain (lower case).  One pass over the texts writes the postings (trigram,
document) of the trigrams that the rules ask for; the postings of each
alternative are intersected; only documents that pass are verified with the
expression itself.  A rule without a mandatory trigram scans every text in full.
SQL functions only: ``split`` and ``regexp_extract_all`` give the pieces
between matches and the matches, and running sums of their lengths the spans.

Defined cases: null text counts as empty and has no spans; rows that repeat a
doc_id are each scanned (the index may propose both, verification decides);
null doc_ids are documents like any other; a text of any length is scanned
whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import written

try:
    from re import _parser as regex_parser  # the standard library's own parse tree
except ImportError:
    import sre_parse as regex_parser


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 1  # matches whose group is shorter are dropped
    base: bool = False


# fixed values: the kinds in their order; the first three are the base
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"sk_live_[0-9a-zA-Z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
)
MOST_ALTERNATIVES = 64
MOST_TRIGRAMS = 4  # of an alternative; any subset of the mandatory ones is safe


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of mandatory trigrams; empty: the rule has none."""
    # a state is the literal text just read and the trigrams so far
    done = _walk(regex_parser.parse(pattern), {("", frozenset())})
    sets = {grams for _, grams in done}
    if not sets or frozenset() in sets:
        return []
    least = [s for s in sets if not any(o < s for o in sets)]
    return sorted(sorted(s)[:: -(-len(s) // MOST_TRIGRAMS)] for s in least)


def _walk(tree, states):
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            states = {_add(s, chr(arg)) for s in states}
        elif name == "IN":
            chars = {chr(a).lower() for o, a in arg if str(o) == "LITERAL"}
            small = all(str(o) == "LITERAL" for o, _ in arg) and len(chars) <= 5
            states = {_add(s, c) for s in states for c in chars} if small else _broken(states)
        elif name == "SUBPATTERN":
            states = _walk(arg[-1], states)
        elif name == "BRANCH":
            states = set().union(*[_walk(branch, states) for branch in arg[1]])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, item = arg
            if (low, high) == (0, 1):
                states = states | _walk(item, states)
            else:
                for _ in range(min(low, 4)):
                    states = _walk(item, states)
                states = _broken(states) if high != low or low > 4 else states
        elif name != "AT":
            states = _broken(states)
        if len(states) > MOST_ALTERNATIVES:  # give up what was learned: fewer conditions, still safe
            states = {("", frozenset())}
    return states


def _add(state, char):
    run, grams = state
    run = (run + char.lower())[-3:]
    return run, grams | {run} if len(run) == 3 else grams


def _broken(states):
    return {("", grams) for _, grams in states}


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, doc_id): the number of each of ``grams`` found in a text."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(i))
                                      for i, g in enumerate(grams)]))
    return low.select("doc_id", F.explode(found).alias("gram"))


def candidates(spark: SparkSession, docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, rules): bit i says that rule i's trigram query holds."""
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    grams = sorted({g for q in queries.values() for alt in q for g in alt})
    terms = [(1 << i, a, grams.index(g), 1 << p, (1 << len(alt)) - 1)
             for i, q in queries.items() for a, alt in enumerate(q) for p, g in enumerate(alt)]
    asked = spark.createDataFrame(terms, "rule long, alt int, gram int, bit int, whole int")
    index = written(spark, postings(docs, grams).sortWithinPartitions("gram"), "trigrams")
    hits = (index.join(F.broadcast(asked), "gram").groupBy("doc_id", "rule", "alt")  # a row per term
            .agg(F.bit_or("bit").alias("got"), F.first("whole").alias("whole")).where("got = whole"))
    return hits.groupBy("doc_id").agg(F.bit_or("rule").alias("rules"))


def spans(text: Column, order: int, rule: Rule) -> Column:
    """[(start, kind order, end)] of a rule's matches in code points."""
    pattern = rule.pattern
    if rule.group == 0 and rule.least > 1 and pattern.endswith("+"):
        # a greedy run: asking for the length inside the expression finds the same
        fixed = sum(1 for op, _ in regex_parser.parse(pattern) if str(op) == "LITERAL")
        pattern = f"{pattern[:-1]}{{{rule.least - fixed},}}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,k:int,e:int>>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["found"])
        here = F.array(F.struct(begin.alias("s"), F.lit(order).alias("k"), end.alias("e")))
        keep = F.length(x["value"]) >= rule.least
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], here)).otherwise(acc["out"])
                        .alias("out"))

    zipped = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("found"),
                          value.alias("value"))
    return F.aggregate(zipped, start, step, lambda a: a["out"])


def joined(all_spans: Column, rules) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(all_spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(spark: SparkSession, docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans."""
    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce("text", F.lit("")).alias("text"))
    proposed = candidates(spark, few, rules).select(F.col("doc_id").alias("__id"), "rules")
    rows = few.join(proposed, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    checked = []
    for i, r in enumerate(rules):
        if trigram_query(r.pattern):
            ask = F.shiftright(F.coalesce("rules", F.lit(0).cast("long")), i).bitwiseAND(F.lit(1)) == 1
        else:  # in full, on every text
            ask = F.col("text").rlike(r.pattern if r.group or not r.pattern.endswith("+")
                                      else f"{r.pattern[:-1]}{{{r.least},}}")
        checked.append(F.when(ask, spans(F.col("text"), i, r)).otherwise(none).alias(f"k{i}"))
    found = rows.select("doc_id", *checked)
    kinds = {r.kind: f"k{i}" for i, r in enumerate(rules)}
    base = F.concat(*[F.col(f"k{i}") for i, r in enumerate(rules) if r.base])
    every = F.concat(*[F.col(f"k{i}") for i in range(len(rules))])
    return found.select(
        "doc_id", *[F.size(kinds[k]).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.array_sort(base), rules), 256).alias("base_sha256"),
        joined(F.array_sort(every), rules).alias("spans"))
