"""Divergence audit of the sources of each language, by Gustavson's row accumulation.

Terms are runs of letters (ASCII letters and every code point above 0x7F), A-Z
lower-cased.  A language keeps the terms that at least ``least_docs`` of its
documents hold.  Each group (lang, source) gives each kept term the smoothed
share p = 1 + floor(10**9 (count + 1) / (N + V)), N the group's occurrences of
kept terms, V their number.  The distance of p from a baseline q is
floor((p - q)**2 / q), summed over all kept terms for a pair of sources, single
for a term against the whole language.

A group holds few of a language's terms.  With p0 and q0 the shares of an absent
term (count 0), a pair's sum is

    V f(p0, q0) + sum over the group's terms of f(p, q0) - f(p0, q0)
                + sum over the peer's terms of f(p0, q) - f(p0, q0)
                + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0).

The terms of a language are dealt to parts of bounded size, each part a
term-major index (for a term the groups that hold it).  A part takes its groups
one by one: a group scatters its terms through the index into one dense
accumulator over its peers.  All sums are of 64-bit integers: the shares of a
group add up to about 10**9, so no sum of their squares passes a few 10**18.
Only accumulators leave a part, one row for
a group and peer, never a pair of postings; rows are added up by pair.  The sums
over terms of one side need only how often each share occurs.

Memory of a part: its postings (about ``PART`` rows) and one accumulator, as
long as the language has sources.  A source or language with a third of all rows
is counted in many tasks (counts are combined there first) and spread over many
parts.

Defined cases: null text, lang and source are empty; every row is a document,
also where rows repeat a doc_id; a group without kept terms has all shares of
count 0, its distances are those to its peers, and no rows of part ``term``;
with V = 0 all pairs are at 0; an only source has no rows of part ``pair``; an
empty table gives no rows.  Columns other than those three are not read.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocorr.llm.common import written
from aerocorr.operators.joins import size_checked_broadcast

LEAST_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
PART = 250_000  # postings of a part of the index
MANY_GROUPS = 100_000  # groups up to which their totals are broadcast; beyond, a shuffle join
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(r"[\x00-\x40\x5B-\x60\x7B-\x7F]")
LONG = 1 << 20  # longer texts are matched in runs cut between terms
HELD = 200_000  # counters kept in a task before they are handed on

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                    ("n", pa.int64()), ("docs", pa.int64())])


def terms_of(text: str) -> list[str]:
    """The terms of a text in order.  Lower-casing the UTF-8 bytes changes A-Z only."""
    low = text.encode().lower().decode()
    out: list[str] = []
    at = 0
    while at < len(low):
        end = len(low)
        if end - at > LONG:
            gap = BREAK.search(low, at + LONG)
            end = gap.start() if gap else end
        out += map(sys.intern, TERM.findall(low, at, end)) if len(low) > LONG else TERM.findall(low, at, end)
        at = end
    return out


def _count(batches):
    """Batches (lang, source, text) -> lang, source, term, n, docs; one row
    with a null term for every group met."""
    def emit(groups):
        rows = [(*g, t, n, held[1][t]) for g, held in groups.items() for t, n in held[0].items()]
        rows += [(*g, None, 0, 0) for g in groups]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), COUNTS.types)], schema=COUNTS)

    groups: dict = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            found = terms_of(text)
            n.update(found)
            docs.update(set(found))
            size += len(n) - before
            if size > HELD:
                yield emit(groups)
                groups, size = {}, 0
    if groups:
        yield emit(groups)


def far(p, q):
    return (p - q) * (p - q) // q


def scatter(part: pd.DataFrame, peers: pd.DataFrame, first_part: bool) -> pd.DataFrame:
    """One part of the index (source, term, p) and all sources of the language
    (source, p0, V): for each group and peer, what the part's terms add to the
    pair's distance; the first part also brings V f(p0, q0)."""
    peers = peers.sort_values("source", kind="stable")
    name = peers["source"].to_numpy()
    p0 = peers["p0"].to_numpy(dtype=np.int64)
    base = peers["V"].to_numpy(dtype=np.int64) * int(first_part)
    code = pd.factorize(part["term"])[0]
    order = np.argsort(code, kind="stable")  # term-major
    term, p = code[order], part["p"].to_numpy(dtype=np.int64)[order]
    who = pd.Index(name).get_indexer(part["source"])[order]
    begin = np.searchsorted(term, np.arange(len(np.unique(term)) + 1))
    rows = np.lexsort((p, who))  # the same postings by group
    first = np.searchsorted(who[rows], np.arange(len(name) + 1))
    new = np.ones(len(rows), dtype=bool)  # how often each source has each share here
    new[1:] = (np.diff(who[rows]) != 0) | (np.diff(p[rows]) != 0)
    head = np.flatnonzero(new)
    has, share, times = who[rows][head], p[rows][head], np.diff(np.append(head, len(rows)))
    out = []
    for i in range(len(name)):
        none = far(p0[i], p0)  # the term absent on both sides
        acc = base * none
        np.add.at(acc, has, times * (far(p0[i], share) - none[has]))  # only the peer has it
        for v, m in zip(share[has == i], times[has == i]):  # only the group has it
            acc += m * (far(v, p0) - none)
        mine = rows[first[i]:first[i + 1]]
        low = begin[term[mine]]
        n = begin[term[mine] + 1] - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)  # postings of the group's terms
        v, j, q = np.repeat(p[mine], n), who[at], p[at]
        np.add.at(acc, j, far(v, q) - far(v, p0[j]) - far(p0[i], q) + none[j])  # both have it
        keep = np.arange(len(name)) != i
        out.append(pd.DataFrame({"source": name[i], "item": name[keep], "value": acc[keep]}))
    return pd.concat(out)


def divergence(spark: SparkSession, docs: DataFrame, least_docs: int = LEAST_DOCS,
               top_terms: int = TOP_TERMS, part_rows: int = PART) -> DataFrame:
    """lang, source, part (``pair``: the item is another source of the language;
    ``term``: a term that the group uses more than its language), item, value,
    rank (from 1 by value, then item)."""
    empty = F.lit("")
    counts = written(spark, docs.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")])
                     .mapInArrow(_count, "lang string, source string, term string, n long, docs long")
                     .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    kept = (counts.where("term is not null").groupBy("lang", "term")
            .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs))
    held = written(spark, counts.where("term is not null").select("lang", "source", "term", "n").join(
        kept.select("lang", "term", "all_n"), ["lang", "term"]), "kept_terms")
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("m"))
    of_lang = (sizes.groupBy("lang").agg(F.sum("size").alias("all_size"), F.sum("m").alias("postings")))
    terms = held.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("V"))
    share = lambda n, size: F.expr(
        f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 1 as decimal(20,0)) div cast({size} + V as decimal(20,0)))")
    zero = F.lit(0).cast("long")
    groups = written(spark, counts.where("term is null").select("lang", "source")
                     .join(sizes, ["lang", "source"], "left")
                     .join(of_lang, "lang", "left").join(terms, "lang", "left")
                     .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "all_size", "V", "postings")])
                     .withColumn("p0", F.when(F.col("V") > 0, share("0", "size")).otherwise(F.lit(1)).cast("long"))
                     .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("postings") / part_rows)).cast("int")), "groups")
    index = written(spark, held.join(size_checked_broadcast(groups, MANY_GROUPS), ["lang", "source"]).select(
        "lang", "source", "term", share("n", "size").cast("long").alias("p"),
        share("all_n", "all_size").cast("long").alias("q"),
        F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part")), "term_index")
    peers = groups.select("lang", "source", "p0", "V", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))

    def accumulate(key, part, sources):
        out = scatter(part, sources, key[1] == 0)
        out.insert(0, "lang", key[0])
        return out

    pairs = (index.select("lang", "part", "source", "term", "p").groupBy("lang", "part")
             .cogroup(peers.groupBy("lang", "part"))
             .applyInPandas(accumulate, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    single = index.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         F.expr("(p - q) * (p - q) div q").alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(by))
    return ranked(pairs).unionByName(ranked(single).where(F.col("rank") <= top_terms))
