"""Licences of files by TF-IDF cosine to templates, inherited along directories.

Every line of a text, every run of lines in which a notice may be wrapped, and every whole text is a
unit: a sparse TF-IDF vector that is compared with the vectors of the notices; whole texts are also
compared with the full texts of licences. Document frequencies of the templates' words are counted
over all texts; other words weigh like words of one text, so a notice inside a long sentence scores
lower than a notice alone. A unit is passed over only if its words cannot reach MIN_COSINE.

A file that opens or closes with a notice, or is one as a whole, licenses its directory. Files
without a licence of their own take that of the nearest directory above them that has one: the
distinct directories are joined to the paths of their ancestors, then the files to their directory.

Defined results: a null text is an empty text without licence; a null path has no directory and
inherits nothing; of equal scores the first template in alphabetical order counts, and of several
licences of one directory the one with the best score, then the smallest path; repeated rows stay
repeated; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import words as W
from tradewatch.llm.scratch import settle

MIN_COSINE = 0.6
SLICE_WORDS = 1 << 17  # of lines or runs of lines compared at once
FULL_TEXTS = Path(__file__).parent / "licence_texts"

# Short notices of common licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause Simplified License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause New or Revised License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


class Terms(NamedTuple):
    """Sorted word hashes of the templates, and whether each word is in each template."""

    names: list[str]
    words: np.ndarray
    counts: np.ndarray


class Weights(NamedTuple):
    """idf of each template word and of all others, and unit vectors of the templates."""

    terms: Terms
    idf: np.ndarray
    other: float
    vectors: np.ndarray


def _chunk(texts: list[str]) -> W.Chunk:
    return next(W.chunks(pa.array(texts, pa.string())))


def full_texts() -> dict[str, str]:
    """The whole texts of licences by name, read in the driver."""
    return {p.stem: p.read_text("utf-8") for p in sorted(FULL_TEXTS.glob("*.txt"))}


def terms_of(templates: dict[str, str]) -> Terms:
    names = sorted(templates)
    found = W.hash_words(_chunk([templates[n] for n in names]), W.PLAIN)
    words, place = np.unique(found.hash, return_inverse=True)
    counts = np.zeros((len(words), len(names)))
    np.add.at(counts, (place, found.row), 1)
    return Terms(names, words, counts)


def _place(terms: Terms, hashes: np.ndarray) -> np.ndarray:
    """Index of each word among the template words, -1 for others."""
    at = np.minimum(np.searchsorted(terms.words, hashes), len(terms.words) - 1)
    return np.where(terms.words[at] == hashes, at, -1)


def count_terms(docs: DataFrame, terms: Terms) -> tuple[int, np.ndarray]:
    """Number of texts, and in how many of them each template word is."""
    size = len(terms.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for chunk in W.chunks(batch.column("text")):
                found = W.hash_words(chunk, W.PLAIN)
                at = _place(terms, found.hash)
                pair = np.unique(found.row[at >= 0] * size + at[at >= 0])
                total += np.bincount(pair % size, minlength=size)
        yield pa.record_batch(
            [pa.array([*range(size), -1]), pa.array([*total.tolist(), rows])], names=["term", "n"]
        )

    # One row for each template word.
    found = (
        docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    ).toArrow()
    known = dict(zip(found.column("term").to_pylist(), found.column("n").to_pylist(), strict=True))
    return known.get(-1, 0), np.array([known.get(i, 0) for i in range(size)])


def weigh(terms: Terms, rows: int, df: np.ndarray) -> Weights:
    idf = np.log((rows + 1) / (df + 1)) + 1
    vectors = (1 + np.log(np.maximum(terms.counts, 1))) * (terms.counts > 0) * idf[:, None]
    vectors /= np.linalg.norm(vectors, axis=0)
    return Weights(terms, idf, float(np.log((rows + 1) / 2) + 1), vectors)


def _damped(n: np.ndarray) -> np.ndarray:
    return (1 + np.log(np.maximum(n, 1))) ** 2 * (n > 0)


def may_match(weights: Weights, known: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether units can reach MIN_COSINE by the sum of idf**2 over their template words and the
    number of their other words, repeated ones included.

    By Cauchy-Schwarz the squared cosine is at most the template words' share of the squared norm.
    A word that is there c times adds (1 + log c)**2, which is at most 4 / e * c; as that is concave,
    n other words add the least if they are all different or all the same.
    """
    least = weights.other**2 * np.minimum(others, _damped(others))
    most = 4 / np.e * known
    return (known > 0) & (most * (1 - MIN_COSINE**2) >= MIN_COSINE**2 * least * (1 - 1e-6))


def best_match(weights: Weights, unit: np.ndarray, hashes: np.ndarray, units: int):
    """Template and cosine of each unit (lines or a text); unit: that of each word, in order.

    Units that cannot reach MIN_COSINE have template -1 and cosine 0.
    """
    best, score = np.full(units, -1), np.zeros(units)
    at = _place(weights.terms, hashes)
    square = np.where(at >= 0, weights.idf[at] ** 2, 0)
    hot = may_match(weights, np.bincount(unit, square, units), np.bincount(unit, at < 0, units))
    take = hot[unit]
    unit, at, hashes = unit[take], at[take], hashes[take]
    if not len(unit):
        return best, score
    order = np.lexsort((hashes, unit))
    unit, at, hashes = unit[order], at[order], hashes[order]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    tf = 1 + np.log(np.diff(np.append(begin, len(unit))))
    unit, at = unit[begin], at[begin]
    weight = tf * np.where(at >= 0, weights.idf[at], weights.other)
    norm = np.sqrt(np.bincount(unit, weight**2, units))
    known = at >= 0
    unit, weight, at = unit[known], weight[known], at[known]
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    dots = np.add.reduceat(weights.vectors[at] * weight[:, None], first, axis=0)
    cosine = dots / np.maximum(norm[unit[first]], 1e-12)[:, None]
    best[unit[first]] = cosine.argmax(axis=1)
    score[unit[first]] = np.round(cosine.max(axis=1), 9)
    return best, score


def _runs(weights: Weights, words: Units, row: np.ndarray, more: int):
    """First lines of the runs of `more` further lines that may hold a notice, among lines with words.

    words: first word and last word + 1 of each line; row: the text of each. A run begins and ends with
    a template word's line, as its cosine is lower otherwise.
    """
    low = np.flatnonzero((row[more:] == row[:-more]) & words.notes[more:] & words.notes[:-more])
    a, b = words.begin[low], words.end[low + more]
    known, others = words.known[b] - words.known[a] + 1e-9, words.others[b] - words.others[a]
    return low[may_match(weights, known, others)]


class Units(NamedTuple):
    """Word ranges of lines; running sums over words of idf**2 of template words, and of other words."""

    begin: np.ndarray
    end: np.ndarray
    notes: np.ndarray
    known: np.ndarray
    others: np.ndarray


def _units(weights: Weights, line: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, Units]:
    """The lines that have words, and their word ranges. line: that of each word."""
    begin = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else line
    end = np.append(begin[1:], len(line))
    at = _place(weights.terms, hashes)
    known = np.append(0, np.cumsum(np.where(at >= 0, weights.idf[at] ** 2, 0)))
    others = np.append(0, np.cumsum(at < 0))
    notes = end - begin - (others[end] - others[begin]) > 0
    return line[begin], Units(begin, end, notes, known, others)


def _matched(weights: Weights, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Number, template and cosine of the word ranges that reach MIN_COSINE, in order.

    Ranges are compared in slices of SLICE_WORDS words, so memory does not follow the text's length.
    """
    size = end - begin
    total = np.append(0, np.cumsum(size))
    low = 0
    while low < len(begin):
        high = max(low + 1, int(np.searchsorted(total, total[low] + SLICE_WORDS, side="right")) - 1)
        some = size[low:high]
        inner = np.arange(some.sum()) + np.repeat(begin[low:high] - np.cumsum(some) + some, some)
        unit = np.repeat(np.arange(len(some)), some)
        best, cosine = best_match(weights, unit, hashes[inner], len(some))
        hit = np.flatnonzero(cosine >= MIN_COSINE)
        yield low + hit, best[hit], cosine[hit]
        low = high


def _firsts(row: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """The first of the best of each row."""
    order = np.lexsort((np.arange(len(row)), -cosine, row))
    return order[np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))] if len(row) else order


def _notice(licence: str, cosine: float, line: int, edge: bool) -> dict:
    return {"licence": licence, "cosine": float(cosine), "line": line, "edge": edge}


def with_notice(files: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Add notice: struct of licence, cosine, line (0 for a whole file, else from 1; the first of
    several lines) and whether it is an edge (whole file, or with the first or last line); null if
    none."""
    short = terms_of(templates or TEMPLATES)
    long = terms_of(full_texts())
    words = np.union1d(short.words, long.words)
    rows, df = count_terms(files, Terms([], words, np.zeros((len(words), 0))))
    weights = weigh(short, rows, df[np.searchsorted(words, short.words)])
    whole = weigh(long, rows, df[np.searchsorted(words, long.words)])

    def notices(texts: pa.Array) -> pa.Array:
        out = []
        for chunk in W.chunks(texts):
            words = W.hash_words(chunk, W.PLAIN)
            lines = W.hash_words(chunk, W.LINES)
            line = np.searchsorted(lines.start, words.start, side="right") - 1
            first = np.searchsorted(lines.row, np.arange(chunk.rows))
            last = np.searchsorted(lines.row, np.arange(chunk.rows), side="right") - 1
            found: list[dict | None] = [None] * chunk.rows

            def offer(row, names, name, cosine, line, edge, found=found):
                if found[row] is None or cosine > found[row]["cosine"]:
                    found[row] = _notice(names[name], cosine, line, edge)

            own, units = _units(weights, line, words.hash)
            row_of = lines.row[own]
            for more in range(int(weights.terms.counts.sum(axis=0).max())):
                if more >= len(own):
                    break
                low = _runs(weights, units, row_of, more) if more else np.flatnonzero(units.notes)
                for hit, best, cosine in _matched(weights, words.hash, units.begin[low], units.end[low + more]):
                    begin, end = own[low[hit]], own[low[hit] + more]
                    for k in _firsts(row_of[low[hit]], cosine):
                        row = row_of[low[hit[k]]]
                        edge = bool(begin[k] == first[row] or end[k] == last[row])
                        offer(row, short.names, best[k], cosine[k], int(begin[k] - first[row]) + 1, edge)
            for kind in (weights, whole):
                best, cosine = best_match(kind, words.row, words.hash, chunk.rows)
                for row in np.flatnonzero(cosine >= MIN_COSINE):
                    offer(row, kind.terms.names, best[row], cosine[row], 0, True)
            out += found
        kind = pa.struct(
            [("licence", pa.string()), ("cosine", pa.float64()), ("line", pa.int64()), ("edge", pa.bool_())]
        )
        return pa.array(out, kind)

    udf = F.arrow_udf(notices, "struct<licence:string,cosine:double,line:long,edge:boolean>")
    return files.withColumn("notice", udf(F.col("text")))


def directory(path: Column) -> Column:
    """The path without its last part; null for a null path."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The folder and all folders above it, nearest first, down to the root."""
    parts = F.split(folder, "/")
    every = F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    return F.array_distinct(F.concat(every, F.array(F.lit(""))))


def scan(files: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, path, licence, cosine, line, origin (own, inherited or none) and licence_path of each file."""
    # Texts stay behind.
    rows = with_notice(files.select(*keys, "path", "text")).select(
        *keys, "path", "notice", directory(F.col("path")).alias("folder")
    )
    rows = settle(rows)
    licensing = rows.filter("folder is not null and notice.edge")
    rank = F.struct((-F.col("notice.cosine")).alias("low"), "path", F.col("notice.licence").alias("licence"))
    # Folded in each task, so a large directory sends one row per task.
    of_folder = licensing.groupBy("folder").agg(F.min(rank).alias("found"))
    folders = (
        rows.filter("notice is null and folder is not null").select("folder").distinct()
    )
    climbed = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("height", "above"))
    nearest = (
        climbed.join(of_folder.withColumnRenamed("folder", "above"), "above")
        .groupBy("folder")
        .agg(F.min(F.struct("height", "found")).alias("near"))
        .select("folder", "near.found")
    )
    joined = rows.join(nearest, "folder", "left")
    own = F.col("notice").isNotNull()
    taken = F.when(own, None).otherwise(F.col("found"))
    return joined.select(
        *keys,
        "path",
        F.coalesce("notice.licence", taken["licence"]).alias("licence"),
        F.coalesce("notice.cosine", -taken["low"]).alias("cosine"),
        F.col("notice.line").alias("line"),
        F.when(own, "own").when(taken.isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(own, F.col("path")).otherwise(taken["path"]).alias("licence_path"),
    )
