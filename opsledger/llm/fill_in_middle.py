"""Fill-in-middle transformation: every whole text becomes prefix, suffix and middle in a new order.

A text is cut after units. A unit ends with a character of the unit's classes (lines: the line
feed; pieces: any white space) or with the text. Texts of a batch lie end to end in one wavelet
matrix over character classes; the number of units before a place is a sum of ranks, and the
place of a cut is found by bisection on that sum. Python sees the text and returns three numbers;
choices, parts and fingerprints are column expressions.

Draws are four 32-bit numbers from the SHA-256 of ``salt:id``, so results do not depend on
partitions, retries or other rows. Defined results:
* null text: as the empty text, n = 0, form ``plain``, output empty;
* a text that contains a sentinel: ``plain``, output the text, no parts;
* null id: the draws of the empty id; repeated rows: equal results, one per row;
* empty table: an empty result with the same columns; other columns of the input are kept, and
  helper columns take names that no input column has (an input column named like a result
  column is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import private
from .wavelet import BLANK, BREAK, LINE_FEED, WaveletMatrix, classes

#: Sentinels of the prefix, the suffix and the middle. No proper end of one begins another, so
#: the first occurrence of a sentinel in an output is the one that was put there.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = {"line": (LINE_FEED,), "piece": (LINE_FEED, BLANK, BREAK)}
#: Code points that are laid end to end at once, unless one text alone is longer.
BUFFER = 1 << 20


def _cuts(points: np.ndarray, end: np.ndarray, first: np.ndarray, second: np.ndarray, ends: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    """Units of each text, and code points before each text's two cuts."""
    start = np.concatenate(([0], end[:-1]))
    codes = classes(points)
    matrix = WaveletMatrix(codes)
    before = matrix.ranks(ends, start)
    whole = matrix.ranks(ends, end) - before
    last = np.zeros(end.size, np.int64)
    full = end > start
    last[full] = ~np.isin(codes[end[full] - 1], ends)
    n = whole + last
    a, b = first % (n + 1), second % (n + 1)
    places = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        place = np.where(k > whole, end, np.maximum(matrix.select(ends, before + np.minimum(k, whole)), start))
        places.append(np.where(k == 0, start, place) - start)
    return n, places[0], places[1]


def _cutter(ends: tuple[int, ...]):
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, first, second in batches:
            out, at = [], 0
            while at < len(texts):
                run, size = [], 0
                while at < len(texts) and (not run or size + len(texts.iat[at] or "") <= BUFFER):
                    run.append(texts.iat[at] or "")
                    size += len(run[-1])
                    at += 1
                here = slice(at - len(run), at)
                points = np.frombuffer("".join(run).encode("utf-32-le"), "<u4")
                end = np.cumsum(np.fromiter(map(len, run), np.int64, len(run)))
                out.append(np.stack(_cuts(points, end, first.to_numpy(np.int64)[here], second.to_numpy(np.int64)[here], ends), 1))
            yield pd.DataFrame(np.concatenate(out) if out else np.empty((0, 3), np.int64), columns=["n", "a", "b"])

    return cut


def _draw(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form alone."""
    p, s, m = (F.locate(x, output) for x in (PREFIX, SUFFIX, MIDDLE))
    width = len(PREFIX)

    def part(begin: Column, end: Column) -> Column:
        return output.substr(begin + F.lit(width), end - begin - F.lit(width))

    over = F.length(output) + F.lit(1)
    psm = F.concat(part(p, s), part(m, over), part(s, m))
    spm = F.concat(part(p, m), part(m, over), part(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", percent: int = 100, spm_percent: int = 50, salt: str = "7") -> DataFrame:
    """Every row with n, form, prefix_chars, middle_chars and output.

    ``percent`` of the texts are transformed, ``spm_percent`` of those put the suffix first.
    Parts are cut after the smaller and the larger of two draws modulo n + 1 units.
    """
    own = private(docs)
    ends = UNITS[unit]
    cut = F.pandas_udf(_cutter(ends), "n long, a long, b long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [c for c in docs.columns if c.lower() not in names]
    out = docs.withColumns({f"{own}text": text, f"{own}hash": digest})
    out = out.withColumn(f"{own}cut", cut(F.col(f"{own}text"), _draw(F.col(f"{own}hash"), 0), _draw(F.col(f"{own}hash"), 1)))
    text, at = F.col(f"{own}text"), F.col(f"{own}cut")
    a, b = at["a"].cast("int"), at["b"].cast("int")
    plain = (text == "") | F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE)) | (_draw(F.col(f"{own}hash"), 2) % 100 >= percent)
    form = F.when(plain, "plain").when(_draw(F.col(f"{own}hash"), 3) % 100 < spm_percent, "spm").otherwise("psm")
    out = out.withColumn(f"{own}form", form)
    form = F.col(f"{own}form")
    p, m = F.concat(F.lit(PREFIX), text.substr(F.lit(1), a)), F.concat(F.lit(MIDDLE), text.substr(a + F.lit(1), b - a))
    s = F.concat(F.lit(SUFFIX), text.substr(b + F.lit(1), F.length(text)))
    output = F.when(form == "plain", text).when(form == "psm", F.concat(p, s, m)).otherwise(F.concat(s, p, m))
    cut_up = form != "plain"
    values = (at["n"], form, F.when(cut_up, at["a"]), F.when(cut_up, at["b"] - at["a"]), output)
    return out.select(*kept, *(v.alias(c) for c, v in zip(names, values, strict=True)))


def digests(docs: DataFrame, **how) -> DataFrame:
    """``fill_in_middle`` with SHA-256 fingerprints of the output and of the text rebuilt from it."""
    out = fill_in_middle(docs, **how)
    output, form = F.col("output"), F.col("form")
    return out.withColumns({"output_sha256": F.sha2(output.cast("binary"), 256), "restored_sha256": F.sha2(restored(output, form).cast("binary"), 256)})
