"""Tables that printed lines lay out, for the lines of many pages at once in arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def cells_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, then of each cell: line, first and last code point in it, first and last byte of what it says). Two or more blanks, a tab or a bar part cells."""
    texts = pc.replace_substring(texts.cast(pa.string()), "\t", "    ")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    blank, bar = data == 32, data == 124
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    # Whether the byte before or after, in the line, parts; blanks are gaps by twos or beside a bar.
    parts = blank | bar
    before, after = np.r_[False, parts[:-1]] & ~edge[:-1], np.r_[parts[1:], False] & ~edge[1:]
    cell = ~(bar | (blank & (before | after)))
    first = np.flatnonzero(cell & (edge[:-1] | ~np.r_[False, cell[:-1]]))
    last = np.flatnonzero(cell & (edge[1:] | ~np.r_[cell[1:], False])) + 1
    said, upto = first + blank[first], last - blank[last - 1]
    real = upto > said
    first, said, upto = first[real], said[real], upto[real]
    line = np.searchsorted(ends, first, "right") - 1
    place = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return data, line, place[first] - place[ends[line]], place[upto] - place[ends[line]], said, upto


def tables(new_page: np.ndarray, number: np.ndarray, texts: pa.Array, least_rows: int, least_columns: int, least_cells: int, spanning: float) -> tuple[np.ndarray, ...]:
    """(line, table, row, column, text) of the cells of all tables of whole pages, whose lines are in order; ``new_page`` marks their first lines."""
    data, line, start, end, said, upto = cells_of(texts)
    rows = np.flatnonzero(np.bincount(line, minlength=len(number)) > 1)
    page = np.cumsum(new_page)
    begins = np.ones(len(rows), bool)
    begins[1:] = (page[rows][1:] != page[rows][:-1]) | (number[rows][1:] != number[rows][:-1] + 1)
    table = np.cumsum(begins) - 1
    height = np.bincount(table)
    table_of, row_of = np.full(len(number), -1), np.zeros(len(number), np.int64)
    table_of[rows] = np.where(height[table] >= least_rows, table, -1)
    row_of[rows] = np.arange(len(rows)) - np.flatnonzero(begins)[table]

    def kept(ok: np.ndarray) -> None:
        nonlocal line, start, end, said, upto
        line, start, end, said, upto = (v[ok] for v in (line, start, end, said, upto))

    kept(table_of[line] >= 0)
    of = table_of[line]
    # How many rows have text, place by place: each table's marks add up to none, so one running sum serves all.
    wide = int(end.max(initial=0)) + 2
    key, at = np.unique(np.r_[of * wide + start, of * wide + end], return_inverse=True)
    covered = np.cumsum(np.bincount(at, weights=np.r_[np.ones(len(of)), -np.ones(len(of))], minlength=len(key)))
    held = covered > spanning * height[key // wide] if len(key) else np.zeros(0, bool)
    closing = key[~held & np.r_[False, held][: len(held)]]
    width = np.bincount(closing // wide, minlength=len(height))
    opening = np.cumsum(width) - width
    ok = width[of] >= least_columns
    kept(ok)
    of = of[ok]
    column = np.minimum(np.searchsorted(closing, of * wide + start, "right") - opening[of], width[of] - 1)
    # A row's cells run from left to right, and so do their columns.
    new = np.ones(len(of), bool)
    new[1:] = (line[1:] != line[:-1]) | (column[1:] != column[:-1])
    filled = np.bincount(of[new], minlength=len(height))
    good = (height >= least_rows) & (width >= least_columns) & (filled >= least_cells)
    ok = good[of]
    kept(ok)
    column, new = column[ok], new[ok]

    shown = rows[good[table]]
    across = width[table_of[shown]]
    base = np.zeros(len(number), np.int64)
    base[shown] = np.cumsum(across) - across
    total = int(across.sum())
    size, apart = upto - said, (~new).astype(np.int64)
    ends = np.r_[0, np.cumsum(np.bincount(base[line] + column, weights=size + apart, minlength=total))].astype(np.int64)
    to = np.cumsum(size + apart) - size
    out = np.full(int(ends[-1]), 32, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(to, size) + step] = data[np.repeat(said, size) + step]
    text = pa.StringArray.from_buffers(total, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes()))
    # Tables of a page that are shown count from 0.
    place = np.cumsum(good) - 1
    first = rows[begins]
    lead = np.zeros(int(page[-1]) + 1 if len(page) else 1, np.int64)
    ones, where = np.unique(page[first[good]], return_index=True)
    lead[ones] = where
    at = np.repeat(shown, across)
    return at, place[table_of[at]] - lead[page[at]], row_of[at], np.arange(total) - np.repeat(base[shown], across), text
