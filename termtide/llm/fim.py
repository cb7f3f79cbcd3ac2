"""Fill-in-middle rewriting of whole texts, cut at line ends by a learned rank index.

A text is cut into units, its lines with their newlines. The offsets of all unit ends
of a slice of rows go into one ``rank_index``, a sequence for each text: line segments
of bounded error predict the offset of each cut from the cut's rank, stored residuals
make it exact. Offsets are bytes inside, code points in the result.

The cuts come from the sha256 of "<seed>:<id>": the first four groups of eight digits
are numbers h1 to h4. The prefix ends after the smaller of h1 % (n + 1) and
h2 % (n + 1) units, the middle after the larger, the suffix is the rest. A text is left
as it is (form "plain") if it is empty, contains one of the marks, or
h3 % 100 >= ``rate``; otherwise it is written suffix first ("spm") if h4 % 100 <
``spm_rate``, else prefix first ("psm").

    psm: <P>prefix<S>suffix<M>middle        spm: <S>suffix<P>prefix<M>middle

Definitions: a null text counts as empty. A null id stands as no digits after the colon.
Rows with equal ids are cut at equal hashes; repeated rows are each rewritten. A text
without a newline is one unit, so that two of its parts are empty. Texts of any length
are one row each and are never split over tasks. An empty table gives an empty result.
Input columns named like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .exchange import flat_text, slices
from .rank_index import fit

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
NEWLINE = 10
NEW_COLUMNS = (
    T.StructType().add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long")
    .add("output_sha256", "string").add("restored_sha256", "string").add("output", "string")
)


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the unit boundaries of all texts end to end, each from 0 to the text's end, and where each text's begin."""
    lengths = np.diff(offsets)
    newlines = np.flatnonzero(data == NEWLINE) + 1
    owner = np.searchsorted(offsets, newlines, side="left") - 1
    # a last line without a newline ends with its text
    open_ = lengths > 0
    open_[open_] = data[offsets[1:][open_] - 1] != NEWLINE
    units = np.bincount(owner, minlength=len(lengths)) + open_
    starts = np.concatenate([[0], np.cumsum(units + 1)])
    bounds = np.zeros(int(starts[-1]), np.int64)
    first = np.searchsorted(newlines, offsets[:-1], side="right")
    bounds[starts[owner] + 1 + np.arange(len(newlines)) - first[owner]] = newlines - offsets[owner]
    bounds[starts[1:][open_] - 1] = lengths[open_]
    return bounds, starts


def hashes_of(seed: int, id_: str | None) -> tuple[int, int, int, int]:
    digits = hashlib.sha256(f"{seed}:{id_ or ''}".encode()).hexdigest()
    return tuple(int(digits[8 * i : 8 * i + 8], 16) for i in range(4))


def written(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "spm":
        return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])


def restored(form: str, output: bytes) -> bytes:
    """The text that was rewritten; marks part the output, as no rewritten text contains one."""
    if form == "plain":
        return output
    front, middle = output.split(MIDDLE)
    if form == "spm":
        suffix, prefix = front[len(SUFFIX) :].split(PREFIX)
    else:
        prefix, suffix = front[len(PREFIX) :].split(SUFFIX)
    return prefix + middle + suffix


def _chars(part: np.ndarray) -> int:
    return int(np.count_nonzero((part & 0xC0) != 0x80))


def rewrite_slice(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int, rate: int, spm_rate: int) -> list[tuple]:
    """(n, form, prefix code points, middle code points, sha256, sha256 of what is rebuilt, output) of each text."""
    bounds, starts = unit_ends(data, offsets)
    index = fit(bounds, starts[:-1])
    units = np.diff(starts) - 1
    h = np.array([hashes_of(seed, i) for i in ids], np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (units + 1), h[:, 1] % (units + 1)
    cut = index.values(starts[:-1] + np.minimum(one, two)), index.values(starts[:-1] + np.maximum(one, two))
    raw = data.tobytes()
    out = []
    for n, begin, end, a, b, h3, h4 in zip(units.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), cut[0].tolist(), cut[1].tolist(), h[:, 2].tolist(), h[:, 3].tolist()):
        text = raw[begin:end]
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
            digest = hashlib.sha256(text).hexdigest()
            out.append((n, "plain", None, None, digest, digest, text))
            continue
        form = "spm" if h4 % 100 < spm_rate else "psm"
        output = written(form, text[:a], text[a:b], text[b:])
        chars = _chars(data[begin : begin + a]), _chars(data[begin + a : begin + b])
        out.append((n, form, *chars, hashlib.sha256(output).hexdigest(), hashlib.sha256(restored(form, output)).hexdigest(), output))
    return out


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """All rows with n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256 and output."""
    taken = {f.name for f in NEW_COLUMNS.fields}
    carried = [c for c in docs.columns if c.lower() not in taken]
    size = len(carried)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(id_col).cast("string").alias("__id"), F.col(text_col).cast("binary").alias("__text"))
    names = [*[f"c{i}" for i in range(size)], *[f.name for f in NEW_COLUMNS.fields]]
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())

    def apply(batches):
        for batch in slices(batches, size + 1):
            data, offsets = flat_text(pa.chunked_array([batch.column(size + 1)]))
            out = rewrite_slice(data, offsets, batch.column(size).to_pylist(), seed, rate, spm_rate)
            new = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(size)], *new], names=names)

    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)] + NEW_COLUMNS.fields[:-1] + [T.StructField("output", T.BinaryType())])
    done = rows.mapInArrow(apply, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *[f.name for f in NEW_COLUMNS.fields[:-1]], F.col("output").cast("string").alias("output"))
