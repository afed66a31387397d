"""Minimal acyclic transducer from words to id sequences, kept as flat arrays that can be memory-mapped."""

from __future__ import annotations

import json

import numpy as np


def compile_words(entries: dict[bytes, list[int]]) -> bytes:
    """The file of an automaton that accepts exactly the given words and outputs their ids.

    Words are added in byte order and equal suffixes are merged as soon as they are closed, so
    the automaton is minimal. An arc's output is the number of words that sort before those
    behind it; the outputs along a word's path sum to its rank, which finds its ids.
    """
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]  # [final, [(byte, state)]] of the open states, from the root

    def close(down_to: int, previous: bytes) -> None:
        while len(path) - 1 > down_to:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            state = register.get(key)
            if state is None:
                state = register[key] = len(states)
                states.append(key)
            path[-1][1].append((previous[len(path) - 1], state))

    last = b""
    for word in words:
        common = 0
        for a, b in zip(last, word):
            if a != b:
                break
            common += 1
        close(common, last)
        for _ in range(len(word) - common):
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0, last)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))

    count: list[int] = []
    for final, arcs in states:  # targets come before their sources
        count.append(int(final) + sum(count[t] for _, t in arcs))
    keys, targets, outputs = [], [], []
    for number, (final, arcs) in enumerate(states):
        before = int(final)
        for byte, target in arcs:
            keys.append(number << 8 | byte)
            targets.append(target)
            outputs.append(before)
            before += count[target]
    ids = [entries[w] for w in words]
    return _packed(
        {
            "root": np.array([root], np.int64),
            "keys": np.array(keys, np.int64),
            "targets": np.array(targets, np.int32),
            "outputs": np.array(outputs, np.int32),
            "final": np.array([f for f, _ in states], np.uint8),
            "starts": np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32),
            "ids": np.array([i for x in ids for i in x], np.uint32),
        }
    )


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    head, body, at = {}, [], 0
    for name, values in arrays.items():
        raw = values.tobytes()
        head[name] = [values.dtype.str, len(values), at]
        body.append(raw + bytes(-len(raw) % 8))
        at += len(body[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


class Automaton:
    """Reads the file of `compile_words` by memory map: one copy in the page cache for all workers of a host."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(raw[:8].tobytes(), "little")
        head = json.loads(raw[8 : 8 + size].tobytes())
        self.arrays = {}
        for name, (dtype, n, at) in head.items():
            start = 8 + size + at
            self.arrays[name] = raw[start : start + n * np.dtype(dtype).itemsize].view(dtype)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words outside the lexicon. All words advance by one byte at a time."""
        n = len(words)
        keys, targets, outputs, final = (self.arrays[k] for k in ("keys", "targets", "outputs", "final"))
        state = np.full(n, int(self.arrays["root"][0]), np.int64)
        rank = np.zeros(n, np.int64)
        if not n or not len(keys):
            return np.full(n, -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, n)
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(words) or b"\0", np.uint8)
        live = np.arange(n)
        for step in range(int(lengths.max(initial=0))):
            live = live[lengths[live] > step]
            if not len(live):
                break
            wanted = state[live] << 8 | text[starts[live] + step]
            arc = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            known = keys[arc] == wanted
            state[live[~known]] = -1
            live, arc = live[known], arc[known]
            state[live] = targets[arc]
            rank[live] += outputs[arc]
        accepted = (state >= 0) & (final[np.maximum(state, 0)] == 1)
        return np.where(accepted, rank, -1)

    def ids(self, rank: int) -> np.ndarray:
        starts = self.arrays["starts"]
        return self.arrays["ids"][starts[rank] : starts[rank + 1]]
