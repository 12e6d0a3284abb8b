"""The keyed state of presence by reference.  The module is sent to executors by value."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class References(StatefulProcessor):
    """The references of one bucket: since which sign of life each is here, and the events whose turn has not come.

    Events wait until the watermark has passed them and are then taken in order of time, so it does not matter which batch brings them.  A call to the
    state costs as much for one event as for thousands: what a batch brings is kept as one chunk, and a bucket has one timer, for the first moment at which something can change.
    """

    def __init__(self, timeout: int):
        self.timeout = timeout

    def init(self, handle) -> None:
        self.handle = handle
        self.here = handle.getValueState("here", "keys array<string>, refs array<string>, at binary")
        self.waiting = handle.getListState("waiting", "keys array<string>, refs array<string>, reference binary, at binary, leaves binary")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for pdf in rows:
            number, keys, refs = _numbered(pdf["presence_key"].to_numpy(object), pdf["presence_ref"].to_numpy(object))
            at = pdf["at_us"].to_numpy(np.int64)
            self.waiting.appendValue((keys, refs, number.tobytes(), at.tobytes(), pdf["leaves"].to_numpy(bool).tobytes()))
            first = min(int(at.min()), first if first is not None else int(at.min()))
        if first is not None:
            self._wake(first, self.timer.get()[0] if self.timer.exists() else None)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = 1000 * timerValues.getCurrentWatermarkInMs()
        keys, refs, at, leaves, is_here = self._events()
        number, keys, refs = _numbered(keys, refs)
        # A reference that is here comes first, with its last sign of life.
        order = np.lexsort((leaves, at, ~is_here, number))
        number, at, leaves, is_here = number[order], at[order], leaves[order], is_here[order]
        later = at > mark
        self._keep(number[later], keys, refs, at[later], leaves[later])
        soonest = [int(at[later].min())] if later.any() else []
        number, at, leaves, is_here = number[~later], at[~later], leaves[~later], is_here[~later]

        same = np.zeros(len(at), bool)
        same[1:] = number[1:] == number[:-1]
        before = np.zeros(len(at), np.int64)
        before[1:] = at[:-1]
        was_here = same.copy()
        was_here[1:] &= ~leaves[:-1]
        lapsed = was_here & (at > before + self.timeout)
        joins = ~leaves & ~is_here & (~was_here | lapsed)
        left = leaves & was_here & ~lapsed
        last = np.ones(len(at), bool)
        last[:-1] = ~same[1:]
        open_end = last & ~leaves
        over = open_end & (at + self.timeout <= mark)
        stays = open_end & ~over
        if stays.any():
            self.here.update(([keys[i] for i in number[stays]], [refs[i] for i in number[stays]], at[stays].tobytes()))
            soonest.append(int(at[stays].min()) + self.timeout)
        else:
            self.here.clear()
        self.timer.clear()
        if soonest:
            self._wake(min(soonest), None)
        found = [("join", joins, at), ("leave", lapsed, before + self.timeout), ("leave", left, at), ("leave", over, at + self.timeout)]
        if any(mask.any() for _, mask, _ in found):
            which = np.concatenate([number[mask] for _, mask, _ in found])
            yield pd.DataFrame({
                "presence_key": [keys[i] for i in which], "presence_ref": [refs[i] for i in which],
                "change": np.concatenate([np.full(mask.sum(), change, object) for change, mask, _ in found]),
                "at_us": np.concatenate([moment[mask] for _, mask, moment in found]),
            })

    def _events(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All that is known of the bucket: keys, references, times, whether it is a leave, and whether it stands for a reference that is here."""
        parts = []
        if self.here.exists():
            keys, refs, at = self.here.get()
            at = np.frombuffer(at, np.int64)
            parts.append((_objects(keys), _objects(refs), at, np.zeros(len(at), bool), np.ones(len(at), bool)))
        if self.waiting.exists():
            for keys, refs, number, at, leaves in self.waiting.get():
                number, at = np.frombuffer(number, np.int64), np.frombuffer(at, np.int64)
                parts.append((_objects(keys)[number], _objects(refs)[number], at, np.frombuffer(leaves, bool), np.zeros(len(at), bool)))
        if not parts:
            parts.append((np.empty(0, object), np.empty(0, object), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, bool)))
        return tuple(np.concatenate(columns) for columns in zip(*parts))

    def _keep(self, number: np.ndarray, keys: list, refs: list, at: np.ndarray, leaves: np.ndarray) -> None:
        """Let the given events wait, and no others."""
        if not len(number):
            self.waiting.clear()
            return
        used, number = np.unique(number, return_inverse=True)
        self.waiting.put([([keys[i] for i in used], [refs[i] for i in used], number.astype(np.int64).tobytes(), at.tobytes(), leaves.tobytes())])

    def _wake(self, at: int, before: int | None) -> None:
        """Have the bucket's one timer go off by then.  Timers count in milliseconds and go off once the watermark has passed them."""
        at = -(-at // 1000)
        if before is not None and before <= at:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _numbered(keys: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Each row's reference as a number, and the key and the name of each number."""
    k, k_values = pd.factorize(keys, use_na_sentinel=False)
    r, r_values = pd.factorize(refs, use_na_sentinel=False)
    pairs, number = np.unique(k.astype(np.int64) * max(len(r_values), 1) + r, return_inverse=True)
    plain = lambda values: [None if v is None or v != v else v for v in values]
    return number.astype(np.int64), plain(k_values[pairs // max(len(r_values), 1)]), plain(r_values[pairs % max(len(r_values), 1)])
