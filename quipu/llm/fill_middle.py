"""Fill-in-the-middle rearrangement of whole texts by displacement scatter.

A text is cut into lines; two cuts between lines, drawn from a digest of seed and id, part
it into prefix, middle and suffix.  The parts change places behind the marks ``<P>``,
``<S>`` and ``<M>``.  All texts of a slice are moved at once: where a part begins, an
array of differences holds by how much its shift differs from that of the part before;
the running sum gives every byte its shift, and one scatter builds all outputs.  The way
back reads only the outputs and their forms: marks are found in the bytes, and the
shifts between them say from where each byte of the text is gathered.

A null text counts as empty.  An empty text, one that holds a mark, and one that the
draw leaves out are ``plain`` and stay as they are, with null sizes of the parts.  A null
id draws from the seed alone, a null form restores nothing (null).  Repeated rows and ids
get a result each.  Very long texts make a slice of their own.  An empty table gives an
empty result.  All other columns stay; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.llm import scan

MARKS = np.frombuffer(b"<P><S><M>", dtype=np.uint8).reshape(3, 3)
PREFIX, SUFFIX, MIDDLE = range(3)
FORMS = np.array(["plain", "psm", "spm"])
PLAIN, PSM, SPM = range(3)
#: The parts of an output in order, for each form that has parts.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
MARK = 3


def draws(id: Column, seed: int, count: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(count)]


def _marks_at(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where marks begin, and which one; none crosses the border of two texts."""
    if len(data) < MARK:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero((data[:-2] == MARKS[0, 0]) & (data[2:] == MARKS[0, 2]))
    which = np.full(256, -1)
    which[MARKS[:, 1]] = np.arange(3)
    kind = which[data[at + 1]]
    text = np.searchsorted(borders, at, side="right") - 1
    good = (kind >= 0) & (at + MARK <= borders[text + 1])
    return at[good], kind[good]


def _cuts(data: np.ndarray, borders: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of lines of each text, and the byte after its ``low``-th and ``high``-th line.

    ``low`` and ``high`` are draws; the cuts are their remainders by the number of lines and one.
    """
    ends = np.flatnonzero(data == 0x0A) + 1
    open_end = (borders[1:] > borders[:-1]) & (data[np.maximum(borders[1:] - 1, 0)] != 0x0A) if len(data) else np.zeros(len(borders) - 1, dtype=bool)
    ends = np.union1d(ends, borders[1:][open_end])
    before = np.searchsorted(ends, borders[:-1], side="right")
    lines = np.searchsorted(ends, borders[1:], side="right") - before
    first, second = low % (lines + 1), high % (lines + 1)
    border = np.append(ends, 0)  # so that an index is valid where there is no line
    at = [np.where(k > 0, border[before + np.maximum(k - 1, 0)], borders[:-1]) for k in (np.minimum(first, second), np.maximum(first, second))]
    return lines, at[0], at[1]


def _displace(size: int, starts: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each of ``size`` bytes, by how much it moves: ``shifts`` from each of the ascending ``starts`` on."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, starts, np.diff(shifts, prepend=0))
    return np.cumsum(steps[:size])


def scatter(data: np.ndarray, borders: np.ndarray, form: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All outputs of a slice, and the borders between them."""
    cut = form != PLAIN
    size = np.diff(borders)
    out_borders = np.concatenate([[0], np.cumsum(size + 3 * MARK * cut)])
    begin, target = borders[:-1], out_borders[:-1]
    lengths = np.stack([one - begin, borders[1:] - two, two - one])  # prefix, suffix, middle
    homes = np.empty((3, len(form)), dtype=np.int64)  # where a part begins in the output
    marks = []
    for kind, order in ORDER.items():
        of = form == kind
        place = target[of].copy()
        for part in order:
            marks.append((place, part))
            homes[part, of] = place + MARK
            place = place + MARK + lengths[part, of]
    plain = ~cut
    homes[PREFIX, plain] = target[plain]
    homes[MIDDLE, plain] = target[plain] + lengths[PREFIX, plain]
    homes[SUFFIX, plain] = homes[MIDDLE, plain] + lengths[MIDDLE, plain]
    # Parts in the order of the text; empty ones begin where the next one does, which then counts.
    starts = np.stack([begin, one, two], axis=1).ravel()
    shifts = np.stack([homes[PREFIX] - begin, homes[MIDDLE] - one, homes[SUFFIX] - two], axis=1).ravel()
    out = np.empty(int(out_borders[-1]), dtype=np.uint8)
    out[np.arange(len(data)) + _displace(len(data), starts, shifts)] = data
    for place, part in marks:
        out[place[:, None] + np.arange(MARK)] = MARKS[part]
    return out, out_borders


def gather(out: np.ndarray, borders: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a slice of outputs, and the borders between them."""
    cut = np.flatnonzero(form != PLAIN)
    at, kind = _marks_at(out, borders)
    of = np.searchsorted(borders, at, side="right") - 1
    own = form[of] != PLAIN
    at, kind = at[own], kind[own]
    if len(at) != 3 * len(cut):
        raise ValueError("an output does not hold each mark once")
    at, kind = at.reshape(-1, 3), kind.reshape(-1, 3)
    size = np.diff(borders)
    size[cut] -= 3 * MARK
    text_borders = np.concatenate([[0], np.cumsum(size)])
    begin = at + MARK
    end = np.concatenate([at[:, 1:], borders[1:][cut][:, None]], axis=1)
    by_part = np.argsort(kind, axis=1)
    begin, length = np.take_along_axis(begin, by_part, axis=1), np.take_along_axis(end - begin, by_part, axis=1)
    starts = np.repeat(text_borders[:-1, None], 3, axis=1)
    shifts = np.repeat((borders[:-1] - text_borders[:-1])[:, None], 3, axis=1)
    place = text_borders[:-1][cut]
    for k, part in enumerate((PREFIX, MIDDLE, SUFFIX)):
        starts[cut, k] = place
        shifts[cut, k] = begin[:, part] - place
        place = place + length[:, part]
    total = int(text_borders[-1])
    source = np.arange(total) + _displace(total, starts.ravel(), shifts.ravel())
    return out[source], text_borders


def _transform(text_index: int, draw_index: int, keep: list[int], percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chance = np.stack([batch.column(draw_index + k).to_numpy() for k in range(4)])
            for a, b, data, borders in scan.slices(batch.column(text_index)):
                h = chance[:, a:b]
                lines, one, two = _cuts(data, borders, h[0], h[1])
                form = np.where(h[3] % 100 < spm_percent, SPM, PSM)
                marked = np.searchsorted(borders, _marks_at(data, borders)[0], side="right") - 1
                form[(np.diff(borders) == 0) | (h[2] % 100 >= percent)] = PLAIN
                form[marked] = PLAIN
                out, ends = scatter(data, borders, form, one, two)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(a, b - a) for i in keep],
                        pa.array(lines, pa.int64()),
                        pa.array(FORMS[form], pa.string()),
                        pa.array(points[one] - points[borders[:-1]], pa.int64(), mask=plain),
                        pa.array(points[two] - points[one], pa.int64(), mask=plain),
                        scan.binary_column(out, ends),
                    ],
                    names=[*[batch.schema.names[i] for i in keep], *RESULT],
                )
            scan.release()

    return run


RESULT = ["n", "form", "prefix_chars", "middle_chars", "output"]
_RESULT_TYPES = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.BinaryType()]


def transform(
    docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """Replace the text of every row by ``n`` (lines), ``form``, sizes of the parts in code points, and ``output``.

    ``percent`` of the texts are rearranged, and of these ``spm_percent`` begin with the suffix.
    """
    keep = [f for f in docs.schema.fields if f.name != text and f.name not in RESULT]
    rows = docs.select(
        *[F.col(f"`{f.name}`") for f in keep],
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_fim_text"),
        *[h.alias(f"_fim_{k}") for k, h in enumerate(draws(F.col(id), seed))],
    )
    schema = T.StructType([*keep, *[T.StructField(n, t) for n, t in zip(RESULT, _RESULT_TYPES)]])
    return rows.mapInArrow(_transform(len(keep), len(keep) + 1, list(range(len(keep))), percent, spm_percent), schema)


def restore(rows: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """Add the bytes of the text that each output was made of, found from the output and its form."""
    names = [n for n in rows.columns if n != out]
    held = rows.select(*[F.col(f"`{n}`") for n in names])
    schema = T.StructType([*held.schema.fields, T.StructField(out, T.BinaryType())])
    number = {name: k for k, name in enumerate(FORMS.tolist())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = np.array([number.get(f, -1) for f in batch.column(names.index(form)).to_pylist()], dtype=np.int64)
            for a, b, data, borders in scan.slices(batch.column(names.index(output))):
                known = forms[a:b] >= 0
                text, ends = gather(data, borders, np.where(known, forms[a:b], PLAIN))
                found = scan.binary_column(text, ends)
                if not known.all():
                    found = pa.array([x if k else None for x, k in zip(found.to_pylist(), known)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, found], names=[*names, out])
            scan.release()

    return held.mapInArrow(run, schema)
