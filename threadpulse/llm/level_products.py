"""How sources of a language differ in their use of words, by products of one-hot level matrices.

Terms are maximal runs of letters (A-Z in lower case); a language keeps those in at least three of its
documents. A term's share in a group is p = 1 + floor(10^9 (count + 1) / (N + V)), with N the group's kept
terms and V the language's different ones. The divergence of two groups adds floor((p - q)^2 / q) over all kept
terms. As p depends on the count alone, it needs only the joint table of the two: how many terms have count a
here and count b there.

Products. A row of the one-hot matrix is a term, a column is (source, count), and the product of the transpose
with the matrix holds the joint tables of all pairs of sources. It is made in blocks: a unit of work is a block
of terms and two blocks of sources, both cut by hashes to a bounded number of entries. Only counts above zero are
stored. Level zero follows by subtraction: a pair's price is taken relative to both counts being zero, so cells
with one zero come from the column sums and the rest is V times the price of (0, 0). A unit prices its part of
the tables in 64-bit integers and hands out one number for each pair of sources; their sums are exact (every
partial sum stays below 4 * 10^18). `joint_tables` returns the cells themselves.

Terms are counted per batch and per task before the shuffle, so a source that holds most rows sends a row a task
and term. No key of a shuffle is a language or a source but in ranks, which take the largest of each task first.

Defined results: NULL text, lang and source read as the empty string, so they form a group of their own. Every
row is a document, also a repeated one. A group without kept terms has count zero for each; a language without
kept terms has pair value 0 and no term rows. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadpulse.llm import folders
from threadpulse.llm import words as W

MIN_DOCS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
#: Sources in a block, entries (source, term) that a block of terms should have, and products taken at a time.
BLOCK_SOURCES, BLOCK_ENTRIES, PRODUCTS = 64, 200_000, 1 << 21

_SEPARATORS = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_GROUPS = ["lang", "source"]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a batch."""
    for batch in W.slices(batches, "text"):
        texts = W.Texts.of(batch.column("text")).lowered()
        found = W.split(texts, _SEPARATORS)
        if not len(found.start):
            continue
        inside = ~texts.flags(_SEPARATORS)
        offsets = np.concatenate([[0], np.cumsum(found.end - found.start)]).astype(np.int64)
        letters = pa.py_buffer(np.ascontiguousarray(texts.data[inside]))
        words = pa.LargeStringArray.from_buffers(len(found.start), pa.py_buffer(offsets), letters).dictionary_encode()
        codes, n = words.indices.to_numpy(), len(words.dictionary)
        langs, sources = (batch.column(c).cast(pa.large_string()).dictionary_encode() for c in _GROUPS)
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        in_group, times = np.unique(group[found.text] * n + codes, return_counts=True)
        in_doc = np.unique(found.text.astype(np.int64) * n + codes)
        pairs, docs = np.unique(group[in_doc // n] * n + in_doc % n, return_counts=True)
        assert len(pairs) == len(in_group)
        which = in_group // n
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(which // len(sources.dictionary))).cast(pa.string()),
                sources.dictionary.take(pa.array(which % len(sources.dictionary))).cast(pa.string()),
                words.dictionary.take(pa.array(in_group % n)).cast(pa.string()),
                pa.array(times),
                pa.array(docs),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ["text", *_GROUPS]))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n: occurrences of the terms that a language keeps, there and in all of it."""
    schema = "lang string, source string, term string, n long, docs long"
    counted = _plain(docs).mapInArrow(_term_counts, schema)
    counted = counted.groupBy(*_GROUPS, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")  # a row a source
    whole = counted.withColumn("lang_n", F.sum("n").over(of_term)).withColumn("lang_docs", F.sum("docs").over(of_term))
    return whole.where(F.col("lang_docs") >= min_docs).select(*_GROUPS, "term", "n", "lang_n")


def totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """For every group of docs: total (N), lang_total (N of the language), different (V), and how many entries
    and sources the language has."""
    own = terms.groupBy(*_GROUPS).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("entries"))
    once = terms.groupBy("lang", "term").agg(F.max("lang_n").alias("n"))
    langs = once.groupBy("lang").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("lang_total"))
    groups = _plain(docs).select(*_GROUPS).distinct().join(own, _GROUPS, "left").na.fill(0)
    sizes = groups.groupBy("lang").agg(F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("sources"))
    return groups.drop("entries").join(sizes.join(langs, "lang", "left").na.fill(0), "lang")


def _share(count: str, total: str) -> str:
    wide = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(19,0))"
    return f"1 + ({wide}) div nullif(CAST({total} + different AS DECIMAL(20,0)), 0)"


def _price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class _Side:
    """One-hot columns of a block of sources, and its entries in order of their terms."""

    def __init__(self, block: int, table: dict[str, np.ndarray], zero: dict[str, np.ndarray]) -> None:
        mine = table["block"] == block
        self.source = np.flatnonzero(zero["block"] == block)  # of the unit's list of sources
        self.p0 = zero["p"][self.source]
        local = np.full(len(zero["block"]), -1)
        local[self.source] = np.arange(len(self.source))
        self.term = table["term"][mine]
        owner, level, share = local[table["source"][mine]], table["n"][mine], table["p"][mine]
        order = np.lexsort((level, owner))
        new = np.ones(len(order), bool)
        new[1:] = (owner[order][1:] != owner[order][:-1]) | (level[order][1:] != level[order][:-1])
        self.column = np.empty(len(order), np.int64)
        self.column[order] = np.cumsum(new) - 1
        first = order[new]
        self.owner, self.level, self.p = owner[first], level[first], share[first]
        self.terms = np.bincount(self.column, minlength=len(first))


def _products(left: _Side, right: _Side, n_terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product of the transposed left matrix with the right one: cells (column, column, terms), in parts whose
    cells add up."""
    by_term = np.argsort(right.term, kind="stable")
    size = np.bincount(right.term, minlength=n_terms)
    begin = np.cumsum(size) - size
    times = size[left.term]
    ends = np.cumsum(times)
    n = len(right.p)
    dense = len(left.p) * n <= PRODUCTS * 4
    block = np.zeros(len(left.p) * n if dense else 0, np.int64)
    at = 0
    while at < len(times):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - times[at] + PRODUCTS, "right")))
        count = times[at:to]
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        theirs = right.column[by_term[np.repeat(begin[left.term[at:to]], count) + within]]
        cell = np.repeat(left.column[at:to], count) * n + theirs
        at = to
        if dense:
            block += np.bincount(cell, minlength=len(block))
        else:
            cells, terms = np.unique(cell, return_counts=True)
            yield cells // n, cells % n, terms
    if dense and n:
        cells = np.flatnonzero(block)
        yield cells // n, cells % n, block[cells]


def _one_way(left: _Side, right: _Side, cells: list, different: int) -> np.ndarray:
    """Prices of each source of left against each of right: those of the cells, of the cells with one zero, and
    different times that of both zero."""
    both = _price(left.p0[:, None], right.p0[None, :])
    value = different * both
    ours = _price(left.p[:, None], right.p0[None, :]) - both[left.owner]
    np.add.at(value, left.owner, left.terms[:, None] * ours)
    theirs = _price(left.p0[:, None], right.p[None, :]) - both[:, right.owner]
    np.add.at(value.T, right.owner, (right.terms * theirs).T)
    for a, b, terms in cells:
        g, h = left.owner[a], right.owner[b]
        price = _price(left.p[a], right.p[b]) - ours[a, h] - theirs[g, b] - both[g, h]
        np.add.at(value, (g, h), terms * price)
    return value


def _unit(table: pa.Table) -> tuple[list[str], _Side, _Side, int, int]:
    """Names of the sources of a unit, its two sides, how many terms it has and its share of V."""
    table = table.combine_chunks()
    of_group = np.asarray(table["term"].is_null())
    names = table["source"].combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    code = names.indices.to_numpy()
    numbers = {c: table[c].to_numpy() for c in ("block", "n", "p", "different")}
    zero = {c: np.zeros(len(names.dictionary), np.int64) for c in ("block", "p")}
    for c in zero:
        zero[c][code[of_group]] = numbers[c][of_group]
    words = table["term"].filter(pa.array(~of_group)).combine_chunks().dictionary_encode()
    entries = {c: numbers[c][~of_group] for c in ("block", "n", "p")}
    entries |= {"source": code[~of_group], "term": words.indices.to_numpy()}
    low, high, k = (table[c][0].as_py() for c in ("low", "high", "k"))
    left = _Side(low, entries, zero)
    right = left if low == high else _Side(high, entries, zero)
    different = int(numbers["different"][of_group][0]) if k == 0 else 0
    return names.dictionary.to_pylist(), left, right, len(words.dictionary), different


_PRICED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
_CELLS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("level", pa.int64())]
    + [("other", pa.string()), ("other_level", pa.int64()), ("terms", pa.int64())]
)


def _priced(table: pa.Table) -> pa.Table:
    names, left, right, n_terms, different = _unit(table)
    cells = list(_products(left, right, n_terms))
    ways = [(left, right, _one_way(left, right, cells, different))]
    if left is not right:
        ways.append((right, left, _one_way(right, left, [(b, a, terms) for a, b, terms in cells], different)))
    name = np.array(names, object)
    out = {"lang": [], "source": [], "item": [], "value": []}
    for one, two, value in ways:
        g, h = (x.reshape(-1) for x in np.meshgrid(one.source, two.source, indexing="ij"))
        other = g != h
        out["source"] += name[g[other]].tolist()
        out["item"] += name[h[other]].tolist()
        out["value"] += value.reshape(-1)[other].tolist()
    out["lang"] = [table["lang"][0].as_py()] * len(out["source"])
    return pa.table(out, _PRICED)


def _joint(table: pa.Table) -> pa.Table:
    names, left, right, n_terms, _ = _unit(table)
    parts = [pa.table({c.name: pa.array([], c.type) for c in _CELLS})]
    name = np.array(names, object)
    for a, b, terms in _products(left, right, n_terms):
        g, h = name[left.source[left.owner[a]]], name[right.source[right.owner[b]]]
        other = g != h
        columns = [g, left.level[a], h, right.level[b], terms]
        arrays = [pa.array(x[other], f.type) for x, f in zip(columns, list(_CELLS)[1:], strict=True)]
        lang = pa.array([table["lang"][0].as_py()] * int(other.sum()), pa.string())
        parts.append(pa.Table.from_arrays([lang, *arrays], schema=_CELLS))
    return pa.concat_tables(parts)


def _units(terms: DataFrame, groups: DataFrame, entries: int, sources: int):
    """The rows of each unit of work, grouped: the entries of a block of terms and two blocks of sources, and a row
    without a term for each of their sources."""
    sized = groups.withColumn("blocks", F.ceil(F.col("sources") / sources).cast("int"))
    sized = sized.withColumn("term_blocks", F.greatest(F.lit(1), F.ceil(F.col("entries") / entries)).cast("int"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    some = terms.join(sized, _GROUPS).withColumn("p", F.expr(_share("n", "total")))
    some = some.withColumn("k", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
    none = sized.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
    none = none.withColumn("p", F.coalesce(F.expr(_share("0", "total")), F.lit(1)))
    columns = ["lang", "k", "source", "block", "blocks", "term", "n", "p", "different"]
    none = none.withColumn("term", F.lit(None).cast("string")).withColumn("n", F.lit(0).cast("long"))
    rows = some.select(columns).unionByName(none.select(columns))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
    return rows.drop("with", "blocks").groupBy("lang", "k", "low", "high")


def joint_tables(
    terms: DataFrame, groups: DataFrame, entries: int = BLOCK_ENTRIES, sources: int = BLOCK_SOURCES
) -> DataFrame:
    """lang, source, level, other, other_level, terms: the cells above zero of the joint tables; of two sources in
    different blocks one of the two tables, as the other is its transpose."""
    ddl = "lang string, source string, level long, other string, other_level long, terms long"
    cells = _units(terms, groups, entries, sources).applyInArrow(_joint, ddl)
    return cells.groupBy("lang", "source", "level", "other", "other_level").agg(F.sum("terms").alias("terms"))


def pair_values(
    terms: DataFrame, groups: DataFrame, entries: int = BLOCK_ENTRIES, sources: int = BLOCK_SOURCES
) -> DataFrame:
    """lang, source, item, value: the divergence of each source from every other one of its language."""
    units = _units(terms, groups, entries, sources)
    parts = units.applyInArrow(_priced, "lang string, source string, item string, value long")
    total = F.sum(F.col("value").cast("decimal(38,0)")).cast("long")
    return parts.groupBy(*_GROUPS, "item").agg(total.alias("value"))


def term_values(terms: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank: the terms that a source uses more than its language, the top ones."""
    priced = terms.join(groups, _GROUPS).withColumn("p", F.expr(_share("n", "total")))
    priced = priced.withColumn("q", F.expr(_share("lang_n", "lang_total"))).where("p > q")
    valued = priced.select(*_GROUPS, F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    return valued.withColumn("rank", _rank()).where(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy(*_GROUPS).orderBy(F.desc("value"), "item"))


def audit(
    docs: DataFrame, top: int = TOP_TERMS, entries: int = BLOCK_ENTRIES, sources: int = BLOCK_SOURCES
) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank for documents (text, lang, source)."""
    terms = folders.written(kept_terms(docs), "kept-terms")
    groups = folders.written(totals(docs, terms), "group-totals")
    pairs = pair_values(terms, groups, entries, sources).withColumn("rank", _rank())
    both = pairs.withColumn("part", F.lit("pair")).unionByName(
        term_values(terms, groups, top).withColumn("part", F.lit("term"))
    )
    return both.select(*_GROUPS, "part", "item", "value", "rank")
