"""What is compared and grouped inside a row, for a batch of rows at a time.

Spark brings the two sides of a step or of a layout pair into one row, as arrays. What is left to do there is a merge of two short
sorted lists; as nested lambdas it is interpreted value by value, so Arrow batches are compared with numpy instead. Nothing here
looks beyond a batch, and a batch is as large as Spark makes it (``spark.sql.execution.arrow.maxBytesPerBatch``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]


Work = Callable[[pa.RecordBatch], pa.RecordBatch]


def over(*works: Work) -> Callable[[Batches], Batches]:
    """``works``, one after the other, on every batch that has rows; for ``mapInArrow``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for work in works:
                if batch.num_rows:
                    batch = work(batch)
            if batch.num_rows:
                yield batch

    return run


def _rows(lists: pa.ListArray) -> np.ndarray:
    """For every value of the lists the row it is of; a missing list has none."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(bool)


def _numbers(values: pa.Array) -> np.ndarray:
    """A whole number for each value, in the order of the values; -1 where one is missing, which is told apart elsewhere."""
    if pa.types.is_integer(values.type):
        return pc.fill_null(values, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = values.dictionary_encode()
    known = coded.dictionary
    number = np.full(len(known) + 1, -1, np.int64)
    number[pc.sort_indices(known).to_numpy()] = np.arange(len(known))
    return number[pc.fill_null(coded.indices, len(known)).to_numpy(zero_copy_only=False)]


def _unequal(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Null-safe: a missing value equals a missing value and no other."""
    both = _numbers(pa.concat_arrays([left, right]))
    return (both[:len(left)] != both[len(left):]) | (_flags(pc.is_null(left)) != _flags(pc.is_null(right)))


def lists_of(row: np.ndarray, values: pa.Array, rows: int) -> pa.ListArray:
    """The values of each of ``rows`` rows as a list; ``row`` ascends."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), values)


def matched(left: pa.ListArray, right: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place on the left, place on the right) of every item of a row, in item order; -1 on a side that has it not.

    Items are distinct on a side. One without a name meets no other.
    """
    items = _numbers(pa.concat_arrays([left.flatten(), right.flatten()]))
    nameless = _flags(pc.is_null(pa.concat_arrays([left.flatten(), right.flatten()])))
    mine = _rows(left)
    row, side = np.concatenate([mine, _rows(right)]), np.arange(len(items)) >= len(mine)
    order = np.lexsort((side, items, ~nameless, row))
    row, items, nameless, side = row[order], items[order], nameless[order], side[order]
    twin = (row[1:] == row[:-1]) & (items[1:] == items[:-1]) & ~nameless[1:] & ~nameless[:-1] & (side[1:] != side[:-1])
    begins = np.flatnonzero(np.concatenate([[True], ~twin])) if len(order) else np.zeros(0, np.int64)
    paired = np.concatenate([twin, [False]])[begins] if len(order) else np.zeros(0, bool)
    first, second = order[begins], order[np.minimum(begins + 1, len(order) - 1)]
    lone = side[begins]
    return row[begins], np.where(lone, -1, first), np.where(lone, first, np.where(paired, second, len(mine) - 1)) - len(mine)


def _taken(values: pa.Array, places: np.ndarray) -> pa.Array:
    return values.take(pa.array(places, mask=places < 0))


def changes(keys: list[str], item: str, attrs: list[str], left: str, right: str) -> Work:
    """Batches of (keys, changes): the items of columns ``_{name}_{left}`` and ``_{name}_{right}`` that are on one side or differ in ``attrs``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = lambda name, side: batch.column(f"_{name}_{side}")
        row, a, b = matched(at(item, left), at(item, right))
        sides = {name: (_taken(at(name, left).flatten(), a), _taken(at(name, right).flatten(), b)) for name in attrs}
        differ = (a < 0) | (b < 0)
        for was, now in sides.values():
            differ |= _unequal(was, now)
        kept = pa.array(np.flatnonzero(differ))
        names = pc.coalesce(_taken(at(item, left).flatten(), a), _taken(at(item, right).flatten(), b))
        fields = {item: names, **{f"{name}{mark}": sides[name][k] for k, mark in enumerate(("_from", "_to")) for name in attrs},
                  "in_left": pa.array(a >= 0), "in_right": pa.array(b >= 0)}
        found = pa.StructArray.from_arrays([values.take(kept) for values in fields.values()], names=list(fields))
        return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], lists_of(row[differ], found, batch.num_rows)], names=[*keys, "changes"])

    return work


def net(keys: list[str], attrs: list[str], ids: list[str], left: str, right: str) -> Work:
    """Rows (keys, ``_n``, ``attrs`` and ``ids`` of both sides, sides) of the numbers ``_n`` that are on one side or differ in ``ids``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = lambda name, side: batch.column(f"_{name}_{side}").flatten()
        row, a, b = matched(batch.column(f"_n_{left}"), batch.column(f"_n_{right}"))
        differ = (a < 0) | (b < 0)
        for name in ids:
            differ |= _unequal(_taken(at(name, left), a), _taken(at(name, right), b))
        row, a, b = row[differ], a[differ], b[differ]
        sides = {f"{name}{mark}": _taken(at(name, side), places) for mark, side, places in (("_from", left, a), ("_to", right, b)) for name in (*attrs, *ids)}
        columns = {**{key: batch.column(key).take(pa.array(row)) for key in keys}, "_n": pc.coalesce(_taken(at("n", left), a), _taken(at("n", right), b)),
                   **sides, "in_left": pa.array(a >= 0), "in_right": pa.array(b >= 0)}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return work


class Signatures:
    """The one-sided members in lists of changes, grouped by (row, geometry): added before removed, by name."""

    def __init__(self, listed: pa.ListArray, geometry: list[str]):
        flat, row = listed.flatten(), _rows(listed)
        alone = np.flatnonzero(~(_flags(flat.field("in_left")) & _flags(flat.field("in_right"))))
        flat, row = flat.take(pa.array(alone)), row[alone]
        self.was, self.member = _flags(flat.field("in_left")), flat.field("member")
        self.geometry = {name: pc.coalesce(flat.field(f"{name}_from"), flat.field(f"{name}_to")) for name in geometry}
        keys = [row]
        for values in self.geometry.values():
            if values.null_count:
                keys.append(~_flags(pc.is_null(values)))
            keys.append(_numbers(values))
        self.order = np.lexsort((_numbers(self.member), self.was, *keys[::-1]))
        edge = np.zeros(max(len(row) - 1, 0), bool)
        for key in keys:
            sorted_ = key[self.order]
            edge |= sorted_[1:] != sorted_[:-1]
        self.begins = np.flatnonzero(np.concatenate([[True], edge])) if len(row) else np.zeros(0, np.int64)
        self.sizes = np.diff(np.append(self.begins, len(row)))
        self.removed = np.add.reduceat(self.was[self.order].astype(np.int64), self.begins) if len(row) else np.zeros(0, np.int64)
        self.added = self.sizes - self.removed
        self.row = row[self.order][self.begins]
        self.both = (self.removed > 0) & (self.added > 0)
        self.single = (self.removed == 1) & (self.added == 1)

    def places(self, at: np.ndarray) -> pa.Array:
        """Rows of the members that stand at these places of the order."""
        return pa.array(self.order[at])


def signatures(keys: list[str], geometry: list[str], named: bool = False) -> Work:
    """Batches of (keys, changes): the geometries that members left and came on, with both numbers and one name of each.

    With ``named`` also the sorted names on either side, ``gone`` and ``came``, where they do not pair one to one.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Signatures(batch.column("changes"), geometry)
        begins, ends, came = s.begins[s.both], (s.begins + s.sizes)[s.both], s.added[s.both]
        fields = {**{name: values.take(s.places(begins)) for name, values in s.geometry.items()}, "removed": pa.array(s.removed[s.both]), "added": pa.array(came),
                  "old": s.member.take(s.places(ends - 1)), "new": s.member.take(s.places(begins + came - 1))}
        if named:
            group = np.repeat(np.cumsum(s.both) - 1, s.sizes)
            asked = np.repeat(s.both & ~s.single, s.sizes) & ~_flags(pc.is_null(s.member))[s.order]
            single = pa.array(s.single[s.both])
            for name, side in (("gone", True), ("came", False)):
                at = np.flatnonzero(asked & (s.was[s.order] == side))
                fields[name] = pc.if_else(single, None, lists_of(group[at], s.member.take(s.places(at)), len(begins)))
        return _filled(batch, keys, s.row[s.both], pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))

    return work


def one_sided(keys: list[str], geometry: list[str]) -> Work:
    """Batches of (keys, changes): the members on one side only that no confirmed rename explains, and the list they are on."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Signatures(batch.column("changes"), geometry)
        group = np.repeat(np.arange(len(s.begins)), s.sizes)
        at = np.flatnonzero(~s.single[group] | _flags(pc.is_null(s.member))[s.order])
        which = pa.array(np.where(s.was[s.order[at]], "removed", "added").astype(object), pa.string())
        return _filled(batch, keys, s.row[group[at]], pa.StructArray.from_arrays([s.member.take(s.places(at)), which], names=["member", "list"]))

    return work


def ambiguous(keys: list[str], geometry: list[str]) -> Work:
    """Batches of (keys, changes): the members of geometries that do not pair one to one."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Signatures(batch.column("changes"), geometry)
        group = np.repeat(np.arange(len(s.begins)), s.sizes)
        at = np.flatnonzero((s.both & ~s.single)[group])
        group, place = group[at], s.places(at)
        side = np.where(s.was[s.order[at]], "removed", "added").astype(object)
        fields = {"member": s.member.take(place), **{name: values.take(place) for name, values in s.geometry.items()}, "removed": pa.array(s.removed[group]),
                  "added": pa.array(s.added[group]), "side": pa.array(side, pa.string())}
        return _filled(batch, keys, s.row[group], pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))

    return work


def _filled(batch: pa.RecordBatch, keys: list[str], row: np.ndarray, values: pa.Array) -> pa.RecordBatch:
    """Keys and lists of the rows that have any value."""
    whole = pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], lists_of(row, values, batch.num_rows)], names=[*keys, "changes"])
    return whole.take(pa.array(np.unique(row)))


def lengths(keys: list[str], geometry: list[str]) -> Work:
    """Batches of keys, how many members were added, removed, moved, resized, rebitted and retyped, and how many are confirmed renames."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = batch.column("changes")
        flat, row = listed.flatten(), _rows(listed)
        left, right = _flags(flat.field("in_left")), _flags(flat.field("in_right"))
        differ = lambda *names: np.logical_or.reduce([_unequal(flat.field(f"{n}_from"), flat.field(f"{n}_to")) for n in names])
        told = lambda side: _flags(pc.fill_null(pc.not_equal(flat.field(f"mtype{side}"), ""), False))
        kinds = [~left, ~right, *[left & right & d for d in (differ("off"), differ("sz"), differ("bit_position", "bit_count"), told("_from") & told("_to") & differ("mtype"))]]
        s = Signatures(listed, geometry)
        counts = [np.bincount(row[kind], minlength=batch.num_rows) for kind in kinds] + [np.bincount(s.row[s.single], minlength=batch.num_rows)]
        names = ["_added", "_removed", "_moved", "_resized", "_rebitted", "_retyped", "n_renamed"]
        return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], *[pa.array(c.astype(np.int64)) for c in counts]], names=[*keys, *names])

    return work


def _first(row: np.ndarray, values: pa.Array, rows: int, most: int) -> pa.Array:
    """The first ``most`` values of each row, nothing where it has none; ``row`` ascends."""
    kept = np.arange(len(row)) - np.searchsorted(row, row) < most
    listed = lists_of(row[kept], values.take(pa.array(np.flatnonzero(kept))), rows)
    return pc.if_else(pc.equal(pc.list_value_length(listed), 0), None, listed)


def heads(keys: list[str], geometry: list[str], names: int, pairs: int) -> Work:
    """What :func:`lengths` gives, the first ``names`` added and removed members that no rename explains, and the first ``pairs`` renames as text."""
    count = lengths(keys, geometry)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted, s = count(batch), Signatures(batch.column("changes"), geometry)
        group, number = np.repeat(np.arange(len(s.begins)), s.sizes), _numbers(s.member)[s.order]
        plain = ~s.single[group] | _flags(pc.is_null(s.member))[s.order]
        columns = []
        for side in (False, True):
            at = np.flatnonzero(plain & (s.was[s.order] == side))
            at = at[np.lexsort((number[at], s.row[group[at]]))]
            columns.append(_first(s.row[group[at]], s.member.take(s.places(at)), batch.num_rows, names))
        begins = s.begins[s.single]
        text = pc.binary_join_element_wise(s.member.take(s.places(begins + 1)), s.member.take(s.places(begins)), " -> ", null_handling="skip")
        columns.append(_first(s.row[s.single], text, batch.num_rows, pairs))
        return pa.RecordBatch.from_arrays([*counted.columns, *columns], names=[*counted.schema.names, "_first_added", "_first_removed", "_first_renamed"])

    return work
