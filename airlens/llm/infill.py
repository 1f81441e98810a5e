"""Fill-in-the-middle documents: each text cut into prefix, middle and suffix, and its exact way back.

The units of a text are its code points. Where it is cut and in which order the
parts follow depends only on the id and ``seed``: the first four 8-digit groups
of the SHA-256 of ``seed:id`` are h1 to h4; the prefix ends after the smaller of
h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger, h3 and h4
choose the form:

* ``psm``: <P>prefix<S>suffix<M>middle
* ``spm``: <S>suffix<P>prefix<M>middle
* ``plain``: the text itself; also every empty text and every text that holds a mark.

The parts are cut in pyarrow.compute, batch by batch: units as list arrays,
flattened with their parents' indices, ordinals compared with the cuts, units
filtered by role, lists rebuilt and joined. At most ``RUN`` bytes are in units at
once; a longer text passes in several runs whose parts are joined.

A null text is empty and plain. A null id is hashed as an empty one. Repeated rows
come back once each, rows with one id are cut at places of that id. Two equal cuts
leave an empty middle. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, map_arrow, text_buffers

# fixed values: the marks of the three parts
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RUN = 1 << 19


def text_runs(raw: np.ndarray, off: np.ndarray, limit: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(byte bounds of runs of at most about ``limit`` bytes of one text, text of each run); cut between code points."""
    bounds, owner = [int(off[0])], []
    for doc, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        while b - a > limit:
            a += limit
            while a < b and raw[a] & 0xC0 == 0x80:   # inside a code point of up to four bytes
                a += 1
            bounds.append(a)
            owner.append(doc)
        bounds.append(b)
        owner.append(doc)
    return np.array(bounds, np.int64), np.array(owner, np.int64)


def _strings(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    own = (bounds - bounds[0]).astype(np.int32)
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(own), pa.py_buffer(raw[bounds[0]:bounds[-1]]))


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """The code points of each text as a list of strings."""
    raw, off = text_buffers(texts)
    piece = pa.array(raw[off[0]:off[-1]])
    starts = pc.indices_nonzero(pc.not_equal(pc.bit_wise_and(piece, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8())))
    units = _strings(raw[off[0]:off[-1]], np.append(starts.to_numpy(), len(piece)).astype(np.int64)) if len(piece) else pa.array([], pa.string())
    ends = pc.cumulative_sum(pc.utf8_length(texts)).to_numpy()
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), units)


def cut_parts(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut after ``first`` and ``second`` units."""
    units = unit_lists(texts)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(pa.array(units.offsets.to_numpy()[:-1], pa.int64()), parent))
    role = pc.add(*[pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(cut), parent)), pa.int8()) for cut in (first, second)])
    parts = []
    for k in range(3):
        mine = pc.equal(role, pa.scalar(k, pa.int8()))
        size = np.bincount(pc.filter(parent, mine).to_numpy(), minlength=len(texts))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pc.filter(flat, mine))
        parts.append(pc.binary_join(lists, ""))
    return parts


def cut_texts(texts: pa.Array, first: np.ndarray, second: np.ndarray, limit: int = RUN) -> list[pa.Array]:
    """``cut_parts`` of texts of any length, with units of at most about ``limit`` bytes in memory."""
    raw, off = text_buffers(texts)
    bounds, owner = text_runs(raw, off, limit)
    cut, at, before, last = [], 0, 0, -1
    while at < len(owner):
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        runs, docs = _strings(raw, bounds[at:stop + 1]), owner[at:stop]
        size = pc.utf8_length(runs).to_numpy().astype(np.int64)
        # units of the same text in earlier runs: of this group, or (first text only) of groups before
        total = np.append(0, np.cumsum(size))
        base = total[:-1] - total[np.searchsorted(docs, docs)]
        base[docs == last] += before
        cut.append(cut_parts(runs, *[np.clip(c[docs] - base, 0, size) for c in (first, second)]))
        before, last = int(base[-1] + size[-1]), int(docs[-1])
        at = stop
    if not cut:
        return [pa.array([], pa.string())] * 3
    runs_of = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
    return [pc.binary_join(pa.ListArray.from_arrays(runs_of, pa.concat_arrays(list(part))), "") for part in zip(*cut)]


def _transform(batches):
    for batch in batches:
        doc, text, n, form, first, second = batch.columns
        text = pc.fill_null(text, "")
        a, b = (c.to_numpy(zero_copy_only=False) for c in (first, second))
        prefix, middle, suffix = cut_texts(text, a, b)
        psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
        spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
        is_psm, is_spm = pc.equal(form, "psm"), pc.equal(form, "spm")
        shown = pc.or_(is_psm, is_spm)
        none = pa.scalar(None, pa.int64())
        yield pa.RecordBatch.from_pydict({
            "doc": doc, "n": n, "form": form,
            "prefix_chars": pc.if_else(shown, pc.cast(pc.utf8_length(prefix), pa.int64()), none),
            "middle_chars": pc.if_else(shown, pc.cast(pc.utf8_length(middle), pa.int64()), none),
            "output": pc.if_else(is_psm, psm, pc.if_else(is_spm, spm, text))})


def fill_in_middle(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = 90,
                   spm_below: int = 20) -> DataFrame:
    """Per document: ``id``, n (code points), form, prefix_chars, middle_chars (null if plain), output.

    Of 100 equally likely values of h3 % 100 those from ``plain_from`` on leave the text plain, of h4 % 100 those
    below ``spm_below`` put the suffix first.
    """
    kind = docs.schema[id].dataType.simpleString()
    said = F.col("text")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc").cast("string"), F.lit(""))), 256)

    def h(k: int) -> Column:
        return F.conv(F.substring("digest", 8 * k - 7, 8), 16, 10).cast("long")

    marked = F.contains(said, F.lit(PREFIX)) | F.contains(said, F.lit(SUFFIX)) | F.contains(said, F.lit(MIDDLE))
    plain = (F.col("n") == 0) | marked | (h(3) % 100 >= plain_from)
    form = F.when(plain, "plain").when(h(4) % 100 < spm_below, "spm").otherwise("psm")
    cuts = [F.when(F.col("form") == "plain", F.col("n")).otherwise(f(h(1) % (F.col("n") + 1), h(2) % (F.col("n") + 1)))
            for f in (F.least, F.greatest)]
    rows = columns(docs, id, text).select(F.col(f"`{id}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")) \
        .withColumns({"n": F.char_length("text").cast("long"), "digest": digest}).withColumn("form", form) \
        .select("doc", "text", "n", "form", cuts[0].alias("first"), cuts[1].alias("second"))
    return map_arrow(rows, _transform, f"doc {kind}, n long, form string, prefix_chars long, middle_chars long, output string") \
        .withColumnRenamed("doc", id)


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form.

    No part holds a mark and no mark overlaps itself, so the first mark of each kind is the one that was put there.
    """
    first = F.split(F.substr(output, F.lit(4)), F.when(form == "psm", SUFFIX).otherwise(PREFIX), 2)
    second = F.split(F.element_at(first, 2), F.lit(MIDDLE), 2)
    head, body, middle = F.element_at(first, 1), F.element_at(second, 1), F.element_at(second, 2)
    return F.when(form == "psm", F.concat(head, middle, body)).when(form == "spm", F.concat(body, middle, head)).otherwise(output)
