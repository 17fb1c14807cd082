"""URL filter: all glob rules of a list simulated at once by a bit-parallel automaton.

Every rule becomes glob patterns over the canonical URL ``host + path``.  The
states of all patterns lie side by side in a few 64-bit words, and one step of
Shift-And with self-loops advances all of them over one character of a whole
batch of URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Steps between checks for URLs whose outcome can no longer change.
SETTLE = 32


@dataclass(frozen=True)
class Rule:
    """``action`` ("allow" or "block") for ``host`` with its subdomains and for
    paths that start with ``path``."""
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        # '*' stays within the host, '>' is a final part of any characters.
        return [f"{self.host}{self.path}>", f"*.{self.host}{self.path}>"]


class Automaton:
    """Multiword Shift-And masks of literal patterns, where ``*`` stands for any
    run of bytes other than ``/`` and a final ``>`` for any rest."""

    def __init__(self, patterns: list[str]):
        parts = [p.encode() for p in patterns]
        width = sum(len(p.replace(b"*", b"").rstrip(b">")) + 1 for p in parts)
        words = max(1, -(-width // 64))
        self.move = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        self.final = np.zeros(words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        inside = np.ones(256, bool)
        inside[ord("/")] = False
        for p in parts:
            word, bit = self._place(at)
            self.start[word] |= bit
            for c in p:
                if c == ord("*"):
                    self.stay[inside, word] |= bit
                elif c == ord(">"):
                    self.stay[:, word] |= bit
                else:
                    at += 1
                    word, bit = self._place(at)
                    self.move[c, word] |= bit
            self.final[word] |= bit
            self.ends.append((word, bit))
            at += 1

    @staticmethod
    def _place(state: int) -> tuple[int, np.uint64]:
        return state // 64, np.uint64(1) << np.uint64(state % 64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """One row per text, one boolean column per pattern."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.concatenate(([0], np.cumsum(size)[:-1])) if len(texts) else size
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        row = np.argsort(-size, kind="stable")
        step = 0
        while len(row):
            row = row[:np.searchsorted(-size[row], -step, side="left")]
            if not len(row):
                break
            if step % SETTLE == 0 and step:
                row = row[((state[row] & ~self.final) != 0).any(axis=1)]
            now = state[row]
            c = data[begin[row] + step]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[row] = (moved & self.move[c]) | (now & self.stay[c])
            step += 1
        return np.stack([(state[:, w] & b) != 0 for w, b in self.ends], axis=1)


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://`` up to ``/ ? #`` or the end, A-Z
    lower-cased) and ``path`` (from there up to ``? #`` or the end).  A null url
    or one without ``://`` has both empty."""
    rest = F.expr(f"case when locate('://', `{url}`) > 0 then substring(`{url}`, locate('://', `{url}`) + 3) else '' end")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = rest.substr(F.length(raw) + 1, F.length(rest))
    return (pages.withColumn("host", F.translate(raw, UPPER, LOWER))
            .withColumn("path", F.regexp_extract(tail, "^[^?#]*", 0)))


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow",
               url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the longest fitting rule, null
    without one; among equally long ones the first listed) and ``verdict`` (its
    action, else ``default``).

    Columns of these names that ``pages`` already has are replaced.  Null and
    empty urls fit no rule; repeated rows are judged alike; an empty rule list or
    table gives defaults or no rows.  The rule list is a parameter of the call and
    travels with the task; URLs are judged where they lie, without a shuffle.
    """
    order = sorted(range(len(rules)), key=lambda i: (len(rules[i].name), -i))
    names = np.array([None] + [rules[i].name for i in order], object)
    actions = np.array([default] + [rules[i].action for i in order], object)
    automaton = Automaton([g for i in order for g in rules[i].globs()]) if rules else None

    @F.pandas_udf(T.StructType([T.StructField("rule", T.StringType()),
                                T.StructField("verdict", T.StringType())]))
    def judged(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        best = np.zeros(len(host), np.int64)
        if automaton is not None and len(host):
            hit = automaton.matches([h.encode() + p.encode() for h, p in zip(host, path)])
            hit = hit.reshape(len(host), len(rules), -1).any(axis=2)
            best = np.where(hit.any(axis=1), len(rules) - np.argmax(hit[:, ::-1], axis=1), 0)
        return pd.DataFrame({"rule": names[best], "verdict": actions[best]})

    return (with_host_path(pages.drop("rule", "verdict", "_judged"), url)
            .withColumn("_judged", judged("host", "path"))
            .withColumn("rule", F.col("_judged.rule"))
            .withColumn("verdict", F.col("_judged.verdict")).drop("_judged"))
