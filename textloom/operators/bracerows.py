"""What braces gather, read in batches of whole tables; the rules are those of braces.groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Codes of kinds, in this order; other kinds and ordinary cells come after.
KINDS = ["open", "up", "close", "leader"]
OPEN, UP, CLOSE, LEADER, OTHER, PLAIN = range(6)
#: Cells read together (a table is not cut), and pairs looked at together.
CHUNK, PAIRS = 1 << 15, 1 << 20
#: Leader dots; a line's end may stand behind, as for Java's $.
DOTS = r"^\.+(\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"
COLUMNS = ["row", "ord", "kind", "x", "first", "n", "title", "title_row", "title_ord", "parent_row", "parent_ord", "closed_by", "covered"]
TYPES = "row int, ord int, kind string, x double, first int, n int, title string, title_row int, title_ord int, parent_row int, parent_ord int, closed_by string, covered array<int>"
_ARROW = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32())]


def _new(a: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    return np.concatenate([np.ones(min(1, len(a)), bool), a[1:] != a[:-1]])


def _spread(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers from start[i] on, count[i] of them: (i, number)."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count - start, count)


def _pairs(start: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """_spread in parts of about PAIRS."""
    part = np.cumsum(count) // PAIRS
    ends = [*np.flatnonzero(_new(part)).tolist(), len(count)]
    for a, z in zip(ends, ends[1:], strict=False):
        owner, x = _spread(start[a:z], count[a:z])
        yield owner + a, x


def _best(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The place of each owner's first greatest value; owners are in order."""
    if not len(owner):
        return np.zeros(0, np.int64)
    begin = np.flatnonzero(_new(owner))
    most = np.repeat(np.maximum.reduceat(value, begin), np.diff([*begin, len(owner)]))
    at = np.flatnonzero(value == most)
    return at[_new(owner[at])]


def _key(table: np.ndarray, row: np.ndarray) -> np.ndarray:
    return (table.astype(np.int64) << 32) + row.astype(np.int64)


def _joined(text: pa.Array, begins: np.ndarray, sep: str) -> pa.Array:
    if len(begins) == len(text):
        return text
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([*begins.tolist(), len(text)], pa.int32()), text), sep)


def _numbers(a: pa.Array) -> np.ndarray:
    return a.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)


def _merged(row: np.ndarray, cells: pa.StructArray) -> tuple:
    """(row, ord, x, kind, height, gap, text) of cells in the order of rows, with leader dots put together (braces.merged_leaders)."""
    ord_ = np.arange(len(row)) - np.maximum.accumulate(np.where(_new(row), np.arange(len(row)), 0))
    text, kind = cells.field("text").cast(pa.string()), cells.field("kind").cast(pa.string())
    code = pc.fill_null(pc.index_in(kind, value_set=pa.array(KINDS)), OTHER).to_numpy(zero_copy_only=False)
    code = np.where(kind.is_null().to_numpy(zero_copy_only=False), PLAIN, code)
    dotted = lambda x: pc.fill_null(pc.match_substring_regex(x, DOTS), False).to_numpy(zero_copy_only=False)
    dots = (code == PLAIN) & dotted(text)
    before = np.concatenate([np.zeros(1, bool), dots[:-1]]) & ~_new(row)
    # a cell without a text, like a dot, goes to the dots before it
    a = np.flatnonzero(~(pc.fill_null(pc.equal(text, "."), True).to_numpy(zero_copy_only=False) & before & (code == PLAIN)))
    text = _joined(text.fill_null(""), a, "")
    row_a, code = row[a], code[a]
    code = np.where((code == PLAIN) & dotted(text) & (pc.utf8_length(text).to_numpy(zero_copy_only=False) > 1), LEADER, code)
    b = np.flatnonzero((code != LEADER) | _new(row_a) | np.concatenate([np.zeros(1, bool), code[:-1] <= CLOSE]))
    at = a[b]
    x, height, gap = (_numbers(cells.field(c))[at] for c in ("x", "height", "gap"))
    return row_a[b], ord_[at], x, code[b], height, gap, _joined(text, b, " ")


def _covered(first: np.ndarray, n: np.ndarray, title: np.ndarray, parent: np.ndarray, deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, row) in order: a group's rows, its title's, and those of all groups below it."""
    at, row = _spread(np.zeros(len(n), np.int64), n + 1)
    row = np.where(row < n[at], first[at] + row, title[at])
    every = [_key(at, row)]
    for _ in range(deepest):  # groups in a circle cover each other
        at = parent[at]
        at, row = at[at >= 0], row[at >= 0]
        if not len(at):
            break
        every.append(_key(at, row))
    every = np.unique(np.concatenate(every))
    return every >> 32, every & 0xFFFFFFFF


def _found(table: np.ndarray, number: np.ndarray, cells: pa.ListArray, pitch: float) -> tuple[np.ndarray, list[pa.Array]]:
    """(place of its table, COLUMNS) of each group of whole tables, whose rows are in order."""
    flat, lengths = cells.flatten(), pc.fill_null(pc.list_value_length(cells), 0).to_numpy(zero_copy_only=False)
    there = flat.is_valid()
    r = np.repeat(np.arange(len(lengths)), lengths)[there.to_numpy(zero_copy_only=False)]
    r, ord_, x, code, height, gap, text = _merged(r, flat.filter(there)) if len(r) else (r, r, r.astype(float), r, r, r, pa.array([], pa.string()))
    begin = np.searchsorted(r, np.arange(len(lengths) + 1))
    rows, row = _key(table, number), number[r]
    total = np.zeros(table[-1] + 1 if len(table) else 0, np.int64)
    total[table[r]] = row + 1  # the last one stays

    # braces, the rows that they span, and the cells there that may be their titles
    b = np.flatnonzero(code <= CLOSE)
    kind, own, t = code[b], row[b], table[r[b]]
    n = np.where(kind == UP, 1, np.maximum(np.nan_to_num(np.rint(height[b] / pitch)), 1)).astype(np.int64)
    far = total[t] - n
    middle = np.rint(own - gap[b] / pitch - (n - 1) / 2.0)
    first = np.where(kind == UP, own, np.maximum(np.minimum(np.where(np.isnan(middle), far, middle), far), 0)).astype(np.int64)
    look, many = np.where(kind == UP, own - 1, first), np.where(kind == UP, 1, np.maximum(np.minimum(first + n, total[t]) - first, 0))
    lo, hi = np.searchsorted(rows, _key(t, look)), np.searchsorted(rows, _key(t, look + many))
    titled, title = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, c in _pairs(begin[lo], np.where(look < 0, 0, begin[hi] - begin[lo])):
        k, plain = kind[i], code[c] == PLAIN
        left, right = x[c] < x[b[i]], x[c] > x[b[i]]
        fits = np.where(k == OPEN, left & (plain | (code[c] == LEADER)), plain & ((k == UP) | right))
        i, c, k, plain = i[fits], c[fits], k[fits], plain[fits]
        some = np.zeros(len(b), bool)
        some[i[plain]] = True  # leaders are a title if there is nothing else
        i, c, k = (a[plain | ~some[i]] for a in (i, c, k))
        at = _best(i, np.where(k == OPEN, x[c], np.where(k == UP, ord_[c], -x[c])))
        titled.append(i[at])
        title.append(c[at])
    g, title = np.concatenate(titled), np.concatenate(title)
    kind, own, t, n, first, gx, gord = kind[g], own[g], t[g], n[g], first[g], x[b[g]], ord_[b[g]]
    at_row = row[title]
    deepest = int(np.bincount(t).max()) if len(t) else 0
    smallest = np.empty(len(t), np.int64)
    smallest[np.lexsort((gord, own, n))] = -np.arange(len(t))

    # the smallest group further left whose rows hold the title
    o = np.flatnonzero(kind != CLOSE)
    h, q = _spread(first[o], n[o])
    k = _key(t[o][h], q)
    by = np.argsort(k, kind="stable")
    k, h = k[by], o[h[by]]
    parent = np.full(len(t), -1, np.int64)
    lo, hi = (np.searchsorted(k, _key(t[o], at_row[o]), side=s) for s in ("left", "right"))
    for i, p in _pairs(lo, hi - lo):
        i, p = o[i], h[p]
        fits = (i != p) & (gx[p] < gx[i]) & (title[p] != title[i])
        i, p = i[fits], p[fits]
        at = _best(i, smallest[p])
        parent[i[at]] = p[at]

    # the groups whose rows a closing brace encloses, and the outermost of them
    c = np.flatnonzero(kind == CLOSE)
    closed: dict[int, bytes] = {}
    stays, around = np.ones(len(t), bool), parent.copy()
    if len(c) and len(o):
        short = np.full(len(t), -1, np.int64)
        short[o] = np.arange(len(o))
        up = np.where(parent[o] < 0, -1, short[parent[o]])
        at, q = _covered(first[o], n[o], at_row[o], up, deepest)
        ends = np.searchsorted(at, np.arange(len(o) + 1))
        low, high, size = q[ends[:-1]], q[ends[1:] - 1], np.diff(ends)
        k = _key(t[o], low)
        by = np.argsort(k, kind="stable")
        lo, hi = (np.searchsorted(k[by], _key(t[c], a)) for a in (first[c], first[c] + n[c]))
        ins, outs = [], []
        for j, i in _pairs(lo, hi - lo):
            i = by[i]
            fits = high[i] < (first + n)[c[j]]
            ins.append(i[fits])
            outs.append(j[fits])
        i, j = np.concatenate(ins), np.concatenate(outs)
        root = (up[i] < 0) | ~np.isin(_key(j, up[i]), _key(j, i))
        i, j = i[root], j[root]
        by = np.lexsort((i, j))
        i, j = i[by], j[by]
        begins = np.flatnonzero(_new(j))
        if len(begins):
            count, most = np.diff([*begins, len(j)]), np.maximum.reduceat(size[i], begins)
            who = c[j[begins]]
            closes = (count == 1) & (most == n[who])
            stays[who[closes]] = False
            names = text.take(pa.array(title[who[closes]])).to_pylist()
            for to, name in zip(o[i[begins[closes]]].tolist(), names, strict=True):
                closed[to] = min(closed.get(to, name.encode()), name.encode())
            around[who] = parent[o[i[begins]]]
            rest = np.repeat(~closes, count)
            i, j = o[i[rest]], c[j[rest]]
            by = np.lexsort((j, i))
            i, j = i[by], j[by]
            at = _best(i, smallest[j])
            around[i[at]] = j[at]

    at, q = _covered(first, n, at_row, np.where(around < 0, -1, around), deepest)
    keep = np.flatnonzero(stays)
    ends = np.searchsorted(at, np.arange(len(t) + 1))
    have = stays[at]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.diff(ends)[keep])]), pa.int32()), pa.array(q[have], pa.int32()))
    above = around[keep]
    none = above < 0
    by_name = np.full(len(t), -1, np.int64)
    by_name[list(closed)] = np.arange(len(closed))
    name = pa.array([v.decode() for v in closed.values()], pa.string()).take(pa.array(by_name[keep], mask=by_name[keep] < 0))
    own_name = pa.array(KINDS).take(pa.array(kind[keep]))
    at = title[keep]
    columns = [own[keep], gord[keep], own_name, gx[keep], first[keep], n[keep], text.take(pa.array(at)), row[at], ord_[at], pa.array(own[above], pa.int32(), mask=none), pa.array(gord[above], pa.int32(), mask=none), name, lists]
    return t[keep], [a.cast(k) if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(columns, _ARROW, strict=True)]


def reader(pitch: float, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For batches (table, row, cells, n_cells: of the table) in which a table's rows lie together: (table, COLUMNS, large) of their groups. A table of more cells than most is not read; large holds (row, cells) of its rows."""

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = batch.column(0)
        new = np.concatenate([np.ones(1, bool), pc.not_equal(table[1:], table[:-1]).to_numpy(zero_copy_only=False)])
        lengths = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(new)
        part = np.cumsum(np.add.reduceat(lengths, begins)) // CHUNK
        ends = [*begins[_new(part)].tolist(), batch.num_rows]
        for a, z in zip(ends, ends[1:], strict=False):
            own, row = np.cumsum(new[a:z]) - 1, batch.column(1)[a:z].to_numpy(zero_copy_only=False)
            by = np.lexsort((row, own))
            cells = batch.column(2)[a:z].take(pa.array(by))
            at, columns = _found(own[by], row[by].astype(np.int64), cells, pitch)
            if len(at):
                yield result(table.take(pa.array(begins[(begins >= a) & (begins < z)][at])), columns, None, batch.schema)

    def result(table: pa.Array, columns: list[pa.Array] | None, large: pa.Array | None, schema: pa.Schema) -> pa.RecordBatch:
        kind = pa.struct([pa.field("row", pa.int32()), pa.field("cells", schema.field("cells").type)])
        columns = columns or [pa.nulls(len(table), k) for k in _ARROW]
        return pa.RecordBatch.from_arrays([table, *columns, pa.nulls(len(table), kind) if large is None else large], ["table", *COLUMNS, "large"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            small = pc.less_equal(batch.column(3), most)
            big = batch.filter(pc.invert(small))
            if big.num_rows:
                yield result(big.column(0), None, pa.StructArray.from_arrays([big.column(1).cast(pa.int32()), big.column(2)], ["row", "cells"]), batch.schema)
            rest = batch.filter(small)
            if not rest.num_rows:
                continue
            last = rest.column(0)[rest.num_rows - 1]
            k = pc.equal(rest.column(0), last).to_numpy(zero_copy_only=False)
            k = int(np.flatnonzero(~k)[-1]) + 1 if not k.all() else 0
            if k or (held and held[-1].column(0)[0] != last):
                yield from read(pa.concat_batches([*held, rest.slice(0, k)]))
                held = []
            held.append(rest.slice(k))
        if held:
            yield from read(pa.concat_batches(held))

    return run
