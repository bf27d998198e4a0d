"""The walk of ``operators.walk`` over Arrow batches: the same records, by arrays instead of flow by flow.

Rows come sorted by connection (and range), then time. Where the connection that opens at a flow ends, and so where the next
one opens, is found for all flows of a batch at once; the connections there are follow from each key's first flow. Their
values are sums over runs of flows. A connection that is open at the end of a batch goes on from its state in the next
one, in the form in which ranges hand theirs on, so memory holds one batch. Sums are added batch by batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowloom.operators.conntrack import FIN, SYN_ACK, _names, key_fields

AT = ["_common", "_low", "_high", "_part"]
#: Rows that are looked at together, and heartbeats that they may have.
ROWS, BEATS = 20_000, 100_000
_START = {"sum": 0.0, "count": 0.0, "min": np.inf, "max": -np.inf}
_JOIN = {"sum": np.add, "count": np.add, "min": np.minimum, "max": np.maximum}


def _first_after(t: np.ndarray, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
    """For each range low to high of the ascending times in it, the first place with a time above ``than``; none: high."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        above = t[np.minimum(middle, len(t) - 1)] > than
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle + 1, low)
    return low


def _next_of(places: np.ndarray, at: np.ndarray, side: str, none: int) -> np.ndarray:
    """The first of the ascending places at (left) or after (right) each of ``at``."""
    return np.append(places, none)[np.searchsorted(places, at, side=side)]


def _beats_before(start: np.ndarray, every: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many of start + every, start + 2 * every, ... lie before the limit."""
    k = np.maximum(np.ceil((limit - start) / every) - 1, 0).astype(np.int64)
    for _ in range(2):  # as the comparison itself decides
        k = np.where((k > 0) & (start + k * every >= limit), k - 1, k)
        k = np.where(start + (k + 1) * every < limit, k + 1, k)
    return k


class Walk:
    """Records of one partition, batch by batch."""

    def __init__(self, conf: dict, kinds: tuple[str, ...], made: pa.Schema):
        self.conf, self.kinds, self.made = conf, kinds, made
        per = lambda what: np.array([g[what] for g in conf["groups"]], np.float64)
        self.gap, self.after_fin, self.every = per("end_timeout"), per("terminating_timeout"), per("heartbeat")
        self.keys, self.inputs, _ = _names(conf)
        beats = "heartbeat" in kinds
        self.rows = int(min(ROWS, max(1, BEATS // (1 + (self.gap / self.every).max())))) if beats else ROWS

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, going = None, None  # the last row, and the state before it of its connection and whether its range is the last
        for b in batches:
            for i in range(0, len(b), self.rows):
                rows = pa.Table.from_batches([b.slice(i, self.rows)])
                rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
                held = rows.slice(len(rows) - 1)
                out, going = self._walked(rows, len(rows) - 1, going)
                yield from out
        if held is not None:
            yield from self._walked(held.combine_chunks(), 1, going)[0]

    def _walked(self, rows: pa.Table, n: int, going: tuple | None) -> tuple[list[pa.RecordBatch], tuple | None]:
        """Records of the first n rows, and how their last range goes on in the row after them (None: it does not)."""
        if n == 0:
            return [], going
        change = np.ones(len(rows), bool)
        change[1:] = False
        for c in AT:
            if c in rows.column_names and len(rows) > 1:
                v = rows[c].chunk(0)
                change[1:] |= pc.not_equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)
        goes_on = n < len(rows) and not change[n]
        first = np.flatnonzero(change[:n])
        states, last = {}, np.ones(len(first), bool)
        if going is not None:
            states[0], last[0] = going
        part = np.cumsum(change[:n]) - 1
        keep = np.ones(n, bool)
        if "_state" in rows.column_names:
            told = rows["_state"].chunk(0)[:n]
            for i in np.flatnonzero(told.is_valid().to_numpy(zero_copy_only=False)):
                states[part[i]], last[part[i]] = pickle.loads(told[int(i)].as_py())
                keep[i] = False
        rows, part = rows.slice(0, n), part[keep]
        if not keep.all():
            rows = rows.filter(pa.array(keep)).combine_chunks()
        low = np.searchsorted(part, np.arange(len(first)))
        high = np.searchsorted(part, np.arange(len(first)), side="right")
        final = last.copy()
        if goes_on:
            final[-1] = False
        out, state = self._records(rows, part, low, high, {k: s for k, s in states.items() if s is not None and low[k] < high[k]}, final) if len(rows) else ([], None)
        if not goes_on:
            return out, None
        if low[-1] == high[-1]:  # no flow of it yet
            state = states.get(len(first) - 1)
        return out, (state, bool(last[-1]))

    def _opened(self, t: np.ndarray, fin: np.ndarray, group: np.ndarray, part: np.ndarray, high: np.ndarray):
        """A function of flows and groups (and whether the flow opens the connection): where the next connection opens,
        and the FIN that ends this one; len(t): none."""
        n, fins = len(t), np.flatnonzero(fin)
        breaks = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        gaps = {}
        for g in np.unique(self.gap):
            far = t[1:] > t[:-1] + g
            gaps[g] = np.union1d(breaks, np.flatnonzero(far) + 1)

        def find(at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            end = np.full(len(at), n)
            for g, places in gaps.items():
                mine = self.gap[number] == g
                end[mine] = _next_of(places, at[mine], "right", n)
            f = _next_of(fins, at, "left", n)
            f = np.where(f < end, f, n)
            hit = np.flatnonzero(f < n)
            if len(hit):
                end[hit] = _first_after(t, f[hit] + 1, high[part[at[hit]]], t[f[hit]] + self.after_fin[number[hit]])
            return end, f

        return find

    def _records(self, rows: pa.Table, part: np.ndarray, low: np.ndarray, high: np.ndarray, states: dict, final: np.ndarray) -> tuple[list[pa.RecordBatch], tuple | None]:
        of = lambda c: rows[c].chunk(0).to_numpy(zero_copy_only=False)
        conf, n = self.conf, len(rows)
        t, flags, group = of("_t"), of("_flags"), of("_group").astype(np.int64)
        from_low = pc.equal(rows["_a"].chunk(0), rows["_low"].chunk(0)).to_numpy(zero_copy_only=False)
        alike = pc.equal(rows["_low"].chunk(0), rows["_high"].chunk(0)).to_numpy(zero_copy_only=False)
        swap = flags & SYN_ACK > 0 if conf.get("swap_ab") else np.zeros(n, bool)
        fin = flags & FIN > 0 if conf.get("detect_end") else np.zeros(n, bool)
        find = self._opened(t, fin, group, part, high)
        following, ended = find(np.arange(n), group)

        # connections that go on from a state: where they end here
        old = np.array(sorted(states), np.int64)
        held = [states[k] for k in old]
        o_low, o_number = low[old], np.array([s[2] for s in held], np.int64)
        o_ends, o_last = np.array([np.nan if s[3] is None else s[3] for s in held], np.float64), np.array([s[4] for s in held], np.float64)
        o_end, o_fin = find(o_low, o_number)
        o_end = np.where(t[o_low] > o_last + self.gap[o_number], o_low, o_end)  # it had ended before
        o_fin = np.where((o_end > o_low) & np.isnan(o_ends), o_fin, n)
        closing = ~np.isnan(o_ends)
        o_end = np.where(closing, _first_after(t, o_low, high[old], o_ends), o_end)

        # and those that open here, from each key's first
        at = low[low < high].copy()
        at[np.searchsorted(part[at], old)] = o_end
        ceiling, opens = high[part[low[low < high]]], []
        while len(at):
            inside = at < ceiling
            at, ceiling = at[inside], ceiling[inside]
            opens.append(at)
            at = following[at]
        opens = np.sort(np.concatenate([*opens, np.empty(0, np.int64)]))

        # all of them, old ones before the others of their key
        start = np.concatenate([o_low, opens])
        place = np.lexsort((np.arange(len(start)) >= len(old), start))
        start, is_old = start[place], place < len(old)
        pick = lambda a, b: np.concatenate([a, b])[place]
        number = pick(o_number, group[opens])
        end, f = pick(o_end, following[opens]), pick(o_fin, ended[opens])
        began = pick(np.array([s[0] for s in held], np.float64), t[opens])
        a_low = pick(np.array([s[1] for s in held], bool), from_low[opens] != swap[opens])
        ends = np.where(f < n, t[np.minimum(f, n - 1)] + self.after_fin[number], pick(o_ends, np.full(len(opens), np.nan)))
        last = np.where(f < n, t[np.minimum(f, n - 1)], np.where((end > start) & np.isnan(ends), t[np.maximum(end - 1, 0)], pick(o_last, t[opens])))
        over = final[part[start]] | (end < high[part[start]])
        until = np.where(np.isnan(ends), last + self.gap[number], ends)

        # heartbeats: those up to a FIN, the end or, of a connection that goes on, the last flow
        every = self.every[number]
        limit = np.where(np.isnan(ends) & over, until, last)
        upto = _beats_before(began, every, limit)
        before = np.zeros(len(start), np.int64)
        before[is_old] = _beats_before(began[is_old], every[is_old], pick(o_last, t[opens])[is_old])
        upto = np.maximum(upto, before)

        # records: connection, kind, the flows up to which they tell, time
        c = np.arange(len(start))
        parts = [(c[over], np.full(over.sum(), 2), end[over], until[over], "newConnection" not in self.kinds and upto[over] == 0)]
        if "newConnection" in self.kinds:
            new = c[~is_old]
            parts.append((new, np.full(len(new), 0), start[new] + 1, t[start[new]], np.ones(len(new), bool)))
        if "heartbeat" in self.kinds:
            many = upto - before
            who = np.repeat(c, many)
            k = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + before[who] + 1
            time = began[who] + k * every[who]
            parts.append((who, np.full(len(who), 1), _first_after(t, start[who], end[who], time), time, (k == 1) & ("newConnection" not in self.kinds)))
        parts.append((c, np.full(len(c), 3), end, np.zeros(len(c)), np.zeros(len(c), bool)))  # what is so at the end of these rows
        who, kind, to = (np.concatenate([p[i] for p in parts]) for i in range(3))
        time = np.concatenate([p[3] for p in parts])
        is_first = np.concatenate([np.broadcast_to(p[4], len(p[0])) for p in parts])
        order = np.lexsort((kind, to, who))
        who, kind, to, time, is_first = who[order], kind[order], to[order], time[order], is_first[order]

        values = self._values(rows, who, to, start, a_low, from_low, alike, {int(i): s for i, s in zip(np.flatnonzero(is_old), held)})
        state = None
        if not over[-1]:
            (i,) = np.flatnonzero((who == len(start) - 1) & (kind == 3))
            told = []
            for a, vs in zip(conf["aggregates"], values):
                one = [v[i].as_py() if isinstance(v, pa.Array) else float(v[i]) for v in vs]
                told.append(one if a_low[-1] or not a.get("split") else one[::-1])
            state = (float(began[-1]), bool(a_low[-1]), int(number[-1]), None if np.isnan(ends[-1]) else float(ends[-1]), float(last[-1]), told)
        shown = np.flatnonzero(np.isin(kind, [("newConnection", "heartbeat", "endConnection").index(k) for k in self.kinds]))
        if not len(shown):
            return [], state
        who, kind, time, is_first = who[shown], kind[shown], time[shown], is_first[shown]
        row = pa.array(start[who])
        columns: dict[str, pa.Array] = {}
        for a, vs in zip(conf["aggregates"], values):
            names = [f"{a['name']}_AB", f"{a['name']}_BA"] if a.get("split") else [a["name"]]
            for name, v in zip(names, vs):
                v = v.take(pa.array(shown)) if isinstance(v, pa.Array) else pa.array(v[shown])
                if pa.types.is_floating(v.type):  # zero and what never came are not shown
                    v = pc.if_else(pc.and_(pc.is_finite(v), pc.not_equal(v, 0)), v, pa.scalar(None, v.type))
                columns[name] = v
        take = lambda x: rows[x].chunk(0).take(row)
        key = conf["key"]
        for x in key["common"]:
            columns[x] = take(self.keys[x])
        forward = pa.array((from_low[start[who]] == a_low[who]) | alike[start[who]])
        for x, y in zip(key.get("a", []), key.get("b", [])):
            p, q = take(self.keys[x]), take(self.keys[y])
            columns[x], columns[y] = pc.if_else(forward, p, q.cast(p.type)), pc.if_else(forward, q, p.cast(q.type))
        columns["_HashId"] = take("_HashId")
        columns["_RecordType"] = pa.array(["newConnection", "heartbeat", "endConnection"]).take(pa.array(kind))
        columns["_IsFirst"], columns["time"] = pa.array(is_first), pa.array(time)
        columns["_EndReason"] = pa.array(["timeout", "FIN_flag"]).take(pa.array((~np.isnan(ends[who])).astype(np.int64), mask=kind != 2))
        return [pa.RecordBatch.from_arrays([_as(columns[g.name], g.type) for g in self.made], schema=self.made)], state

    def _values(self, rows: pa.Table, who, to, start, a_low, from_low, alike, states: dict) -> list[list]:
        """Each aggregate's values (of those by side: A's, B's) of each connection's flows up to each of ``to``."""
        first = np.append(True, who[1:] != who[:-1])
        at = np.where(first, start[who], np.append(0, to[:-1]))  # flows between one record and the next are a run
        size = to - at
        run = np.repeat(np.arange(len(who)), size)
        rank = np.arange(len(who)) - np.maximum.accumulate(np.where(first, np.arange(len(who)), 0))
        later = np.argsort(rank, kind="stable")
        later = np.split(later, np.flatnonzero(np.diff(rank[later])) + 1)[1:]
        # all flows lie in the runs, in order, for a key's connections follow each other
        conn = np.repeat(who, size)
        forward = (from_low == a_low[conn]) | alike
        some, lead = size > 0, np.cumsum(size) - size
        out = []
        for i, a in enumerate(self.conf["aggregates"]):
            op = a["operation"]
            if op in ("first", "last"):
                out.append([self._whole(rows[self.inputs[a["input"]]].chunk(0), op, who, to, start, {c: s[5][i][0] for c, s in states.items()})])
                continue
            v = np.ones(len(rows)) if op == "count" else rows[f"a{i}"].chunk(0).to_numpy(zero_copy_only=False)
            none, both = _START[op], []
            for side in ([forward, ~forward] if a.get("split") else [None]):
                mine = np.where(np.isnan(v) if side is None else np.isnan(v) | ~side, none, v)
                if op in ("sum", "count"):
                    total = np.bincount(run, weights=mine, minlength=len(who))
                else:
                    total = np.full(len(who), none)
                    if some.any():
                        total[some] = _JOIN[op].reduceat(mine, lead[some])
                for c, s in states.items():
                    earlier = s[5][i]
                    earlier = earlier if s[1] or not a.get("split") else earlier[::-1]
                    k = np.searchsorted(who, c)
                    total[k] = _JOIN[op](earlier[len(both)], total[k])
                for more in later:
                    total[more] = _JOIN[op](total[more - 1], total[more])
                both.append(total)
            out.append(both)
        return out

    def _whole(self, v: pa.Array, op: str, who, to, start, earlier: dict) -> pa.Array:
        """The first, or the last present, value of each connection's flows up to each of ``to``."""
        ok = v.is_valid().to_numpy(zero_copy_only=False)
        if pa.types.is_floating(v.type):
            ok = ok & ~np.isnan(v.to_numpy(zero_copy_only=False))
        if op == "first":
            place = start[who]
            none = ~ok[place]
        else:
            seen = np.maximum.accumulate(np.where(ok, np.arange(len(v)), -1))
            place = np.where(to > start[who], seen[np.maximum(to - 1, 0)], -1)
            none = place < start[who]
        found = v.take(pa.array(np.where(none, 0, place), mask=none))
        kept = [k for k in range(len(who)) if who[k] in earlier and (op == "first" or none[k])] if earlier else []
        if kept:
            values = found.to_pylist()
            for k in kept:
                values[k] = earlier[who[k]]
            found = pa.array(values, v.type)
        return found


def _as(v: pa.Array, kind: pa.DataType) -> pa.Array:
    if v.type == kind:
        return v
    try:
        return v.cast(kind)
    except (pa.ArrowNotImplementedError, pa.ArrowInvalid):
        return pa.array(v.to_pylist(), kind)
