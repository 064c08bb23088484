"""Bytes between tasks that run side by side (a barrier stage).

``allGather`` of Spark waits a second however little is sent.  Where the tasks share a folder they
leave their bytes there instead, each in a file that appears as a whole and goes when all have read it.
"""

from __future__ import annotations

import base64
import os
import sys
import time
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import SparkSession

from ..session import shared_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Seconds between two looks for a file, at first and at most, and until a task gives up.
LOOK_S, LONGEST_LOOK_S, WAIT_S = 0.0005, 0.004, 1800.0


def meeting_folder(spark: SparkSession) -> str | None:
    """A new folder below the shared one, if that is a plain path; whether all tasks reach it they find out themselves."""
    root = shared_root(spark)
    if root.startswith("file:"):
        root = "/" + root[len("file:") :].lstrip("/")
    if "://" in root or not os.path.isabs(root):
        return None
    path = f"{root.rstrip('/')}/sums-{uuid.uuid4().hex}"
    try:
        os.makedirs(path)
    except OSError:
        return None
    return path


class Meeting:
    """What the tasks of a barrier stage tell each other; all of them make the same calls in the same order.

    Without a folder that all of them reach they send ``gathered`` bytes at a time through Spark.
    """

    def __init__(self, context, folder: str | None, gathered: int):
        self.context, self.gathered, self.me, self.turn = context, gathered, context.partitionId(), 0
        token = uuid.uuid4().hex
        path = None if folder is None else f"{folder}/{token}"
        try:
            if path is not None:
                with open(path, "wb"):
                    pass
        except OSError:
            path = None
        tokens = context.allGather(token if path else "")
        self.n = len(tokens)
        seen = all(t and os.path.exists(f"{folder}/{t}") for t in tokens)
        self.folder = folder if all(x == "1" for x in context.allGather("1" if seen else "0")) else None
        # Another attempt of the stage has other names.
        self.name = tokens[0]
        if path is not None:
            os.remove(path)

    def swap(self, parts: Sequence[bytes]) -> list[bytes]:
        """Part j of every task goes to task j: those for this task, in the tasks' order."""
        ends = np.cumsum([0, *map(len, parts)], dtype="int64")
        if self.folder is None:
            return [whole[a:b] for whole, a, b in self._gathered(ends, parts)]
        return self._posted(ends, parts)

    def share(self, part: bytes) -> list[bytes]:
        """The parts of all tasks, in their order."""
        ends = np.array([0] + [len(part)] * self.n, dtype="int64")
        if self.folder is None:
            return [whole for whole, _, _ in self._gathered(ends, [part])]
        return self._posted(ends, [part], whole=True)

    def _path(self, turn: int, task: int) -> str:
        return f"{self.folder}/{self.name}-{turn}-{task}"

    def _posted(self, ends: np.ndarray, parts: Sequence[bytes], whole: bool = False) -> list[bytes]:
        turn, self.turn = self.turn, self.turn + 1
        mine = self._path(turn, self.me)
        with open(f"{mine}.new", "wb") as f:
            f.write(ends.tobytes())
            for part in parts:
                f.write(part)
        os.replace(f"{mine}.new", mine)
        # Whoever has posted the turn before this one has read all files of the turn before that.
        if turn > 1:
            os.remove(self._path(turn - 2, self.me))
        out = []
        for task in range(self.n):
            with self._opened(self._path(turn, task)) as f:
                held = np.frombuffer(f.read(8 * (self.n + 1)), dtype="int64")
                start, stop = (0, held[-1]) if whole else held[self.me : self.me + 2]
                f.seek(8 * len(held) + int(start))
                out.append(f.read(int(stop - start)))
        return out

    def _opened(self, path: str):
        pause, until = LOOK_S, time.monotonic() + WAIT_S
        while True:
            try:
                return open(path, "rb", buffering=0)
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise TimeoutError(f"another task has left nothing for {WAIT_S} s") from None
                time.sleep(pause)
                pause = min(2 * pause, LONGEST_LOOK_S)

    def _gathered(self, ends: np.ndarray, parts: Sequence[bytes]) -> list[tuple[bytes, int, int]]:
        """Each task's bytes, and where those for this task begin and end."""
        data, step = ends.tobytes() + b"".join(parts), max(1, self.gathered // self.n)
        pieces: list[list[bytes]] = [[] for _ in range(self.n)]
        start, longest = 0, 1
        while start < longest:
            piece = base64.b64encode(data[start : start + step]).decode()
            for task, text in enumerate(self.context.allGather(f"{len(data)} {piece}")):
                size, _, rest = text.partition(" ")
                longest = max(longest, int(size))
                pieces[task].append(base64.b64decode(rest))
            start += step
        out = []
        for found in pieces:
            whole = b"".join(found)
            held = np.frombuffer(whole[: 8 * (self.n + 1)], dtype="int64")
            out.append((whole[8 * len(held) :], int(held[self.me]), int(held[self.me + 1])))
        return out

    def close(self) -> None:
        """Take the last files away, when all have read them."""
        if self.folder is not None:
            self.share(b"")
            self.context.barrier()
            for turn in range(max(0, self.turn - 2), self.turn):
                os.remove(self._path(turn, self.me))
