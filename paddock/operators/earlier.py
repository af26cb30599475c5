"""What a horse did on earlier days, for runs that come sorted by horse and day.

Batches may end anywhere: of the horse at the end its sums by key and its latest runs go on to the next batch, so a task
holds one batch and the different keys of one horse, however many runs the horse has."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Day of runs that have none; they sort before the others and count nowhere.
NO_DAY = -(2**40)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """For each row of a sorted list the first row with the same keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _codes(columns: Sequence[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Small numbers for the different keys, and where no part of the key is null."""
    codes, known = np.zeros(n, np.int64), np.ones(n, bool)
    for c in columns:
        coded = c.dictionary_encode()
        found = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes, known = codes * (len(coded.dictionary) + 1) + found + 1, known & (found >= 0)
    return codes, known


def _summed(values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=out[1:])
    return out


def _before(horse: np.ndarray, day: np.ndarray, codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the rows of the same horse and code with an earlier day."""
    group = horse * (codes.max(initial=0) + 1) + codes
    order = np.argsort(group, kind="stable")  # days stay in order
    sums, g, d = _summed(values[order]), group[order], day[order]
    out = np.empty(values.shape)
    out[order] = sums[_starts(g, d)] - sums[_starts(g)]
    return out


def _before_near(horse: np.ndarray, day: np.ndarray, number: np.ndarray, values: np.ndarray, tolerance: float) -> np.ndarray:
    """The same over rows whose number is within ``tolerance`` of the row's own; each number of the horse in that
    range is looked up once for a row."""
    numbers, code = np.unique(number, return_inverse=True)
    group = horse * len(numbers) + code
    order = np.argsort(group, kind="stable")
    sums, g = _summed(values[order]), group[order]
    starts = np.flatnonzero(_starts(g) == np.arange(len(g)))
    groups, days = g[starts], np.unique(day, return_inverse=True)[1]
    at = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(g)])) * (len(g) + 1) + days[order]
    first = np.searchsorted(groups, horse * len(numbers) + np.searchsorted(numbers, numbers * (1 - tolerance))[code])
    end = np.searchsorted(groups, horse * len(numbers) + np.searchsorted(numbers, numbers * (1 + tolerance), "right")[code])
    out, left = np.zeros(values.shape), np.flatnonzero(first < end)
    while len(left):
        near = first[left]
        out[left] += sums[np.searchsorted(at, near * (len(g) + 1) + days[left])] - sums[starts[near]]
        first[left] += 1
        left = left[first[left] < end[left]]
    return out


def _joined(texts: pa.Array, end: np.ndarray, count: np.ndarray) -> pa.Array:
    """The ``count`` texts before each ``end``, the last one first."""
    offsets = np.r_[0, np.cumsum(count)]
    back = np.arange(offsets[-1]) - np.repeat(offsets[:-1], count)
    rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts.take(pa.array(np.repeat(end - 1, count) - back)))
    return pc.binary_join(rows, ",")


class _Sums:
    """Sums of one context; ``rest`` are those of the horse at the end, by key and for its last day and the days before."""

    def __init__(self, columns: Sequence[str]):
        self.columns, self.rest = columns, None

    def run(self, batch: pa.RecordBatch, goes_on: bool, horse: np.ndarray, day: np.ndarray, values: np.ndarray, tolerance: float | None = None) -> np.ndarray:
        """Sums before each row of the batch, after those taken over if it begins within a horse."""
        keys = [batch[c] for c in self.columns]
        if goes_on:
            old, days, sums = self.rest
            keys, day, values = [pa.concat_arrays(k) for k in zip(old, keys)], np.r_[days, day], np.r_[sums, values]
            horse = np.r_[np.zeros(len(days), np.int64), horse]
        codes, known = _codes(keys, len(day))
        values = values * known[:, None]
        if tolerance is None:
            out = _before(horse, day, codes, values)
        else:
            number = np.where(known, keys[0].fill_null(0).to_numpy(zero_copy_only=False), 0)
            out = _before_near(horse, day, number, values, tolerance) * known[:, None]
        at = np.searchsorted(horse, horse[-1])
        _, first, kind = np.unique(codes[at:] * 2 + (day[at:] == day[-1]), return_index=True, return_inverse=True)
        days, sums = np.full(len(first), NO_DAY), np.zeros((len(first), values.shape[1]))
        np.maximum.at(days, kind, day[at:])
        np.add.at(sums, kind, values[at:])
        self.rest = [k.take(pa.array(first + at)) for k in keys], days, sums
        return out[len(day) - len(batch) :]


def earlier_runs(contexts: Mapping[str, Sequence[str]], near: str, tolerance: float, texts: Mapping[str, tuple[str, int]], weights: Sequence[int], names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over runs sorted by horse and day, with ``_nth`` (the run's number within the horse), ``_day``, ``_known`` (horse and
    day are), ``_position`` and ``_points``: sums before each run, in all, for each of ``contexts`` and for numbers about ``near``; the latest of each of
    ``texts``, joined; and ``_score``, the latest points by ``weights``. Of ``names``, the columns of the result, those not made here are passed on."""
    longest = max([n for _, n in texts.values()] + [len(weights)])
    shown = sorted({c for c, _ in texts.values()} | {"_points"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, kinds, rest = _Sums(()), {k: _Sums(c) for k, c in contexts.items()} | {"distance": _Sums((near,))}, None
        for batch in batches:
            if not len(batch):
                continue
            new = batch["_nth"].to_numpy() == 1
            horse, goes_on = np.cumsum(new), not new[0]
            known = batch["_known"].to_numpy(zero_copy_only=False)
            day = np.where(known, batch["_day"].fill_null(0).to_numpy().astype(np.int64), NO_DAY)
            place = batch["_position"].fill_null(np.nan).to_numpy()
            ran = known & ~np.isnan(place)
            values = np.stack([known, ran & (place == 1), ran & (place <= 3), ran & (place == 2), ran & (place == 3), ran, np.where(ran, place, 0)], 1).astype(float)
            sums = every.run(batch, goes_on, horse, day, values)
            n = sums[:, 0]
            out = {f"total_{k}": sums[:, i] for i, k in enumerate(("races", "wins", "places", "seconds", "thirds"))} | {"_finished": sums[:, 5], "_places": sums[:, 6]}
            for name, kind in kinds.items():
                sums = kind.run(batch, goes_on, horse, day, values[:, :3], tolerance if name == "distance" else None)
                out |= {f"{name}_{k}": sums[:, i] for i, k in enumerate(("runs", "wins", "places"))}
            # the runs themselves: those taken over, then the batch's
            at = np.flatnonzero(known)
            held = [batch[c].take(pa.array(at)) for c in shown]
            hh, hd = horse[at], day[at]
            if goes_on:
                held, hh, hd = [pa.concat_arrays(x) for x in zip(rest[0], held)], np.r_[np.zeros(len(rest[1]), np.int64), hh], np.r_[rest[1], hd]
            held_of = dict(zip(shown, held))
            end, count = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            first = _starts(hh, hd)[len(hh) - len(at) :]
            end[at], count[at] = first, first - _starts(hh)[len(hh) - len(at) :]
            made = {name: _joined(held_of[c], end, np.minimum(count, k)) for name, (c, k) in texts.items()}
            points, score = np.r_[held_of["_points"].fill_null(0).to_numpy(), 0], np.zeros(len(batch), np.int64)
            for i, w in enumerate(weights):
                score += np.where(count > i, points[end - 1 - np.minimum(i, count)] * w, 0)
            made["_score"] = pa.array(score, mask=count == 0)
            last = np.r_[hd, NO_DAY][end - 1]
            made["days_since_last_run"] = pa.array(np.where(n > 0, day - last, 0).astype(np.int32), mask=n == 0)
            own = np.searchsorted(hh, horse[-1])
            cut = own + np.searchsorted(hd[own:], hd[-1] if len(hd) else 0)
            keep = np.r_[max(own, cut - longest) : cut, max(cut, len(hd) - longest) : len(hd)].astype(np.int64)
            rest = [x.take(pa.array(keep)) for x in held], hd[keep]
            made |= {k: pa.array(v.astype(np.int64)) for k, v in out.items() if k in names}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch[c] for c in names], names=list(names))

    return run
