"""Minimal acyclic transducer: a word list as an automaton with shared prefixes and
suffixes whose arcs carry numbers; along a word they add up to its place in the
sorted list, which is where its outputs stand.
"""

from __future__ import annotations

import numpy as np

from . import hashmap


def compile_words(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the automaton over sorted distinct words. State 0 is the start.

    Built incrementally (Daciuk et al., 2000): once a word no longer shares a
    state, the state is replaced by an equal one if there is any, so the automaton
    is minimal at the end.
    """
    register: dict[tuple, int] = {}
    arcs: list[list[tuple[int, int]]] = []  # of each finished state
    final: list[bool] = []

    def finish(node: list) -> int:
        sign = (node[0], tuple(node[1]))
        found = register.get(sign)
        if found is None:
            found = register[sign] = len(arcs)
            arcs.append(node[1])
            final.append(node[0])
        return found

    path: list[list] = [[False, []]]  # open states along the last word: [final, finished arcs]
    before = b""
    for w in words:
        common = 0
        while common < min(len(w), len(before)) and w[common] == before[common]:
            common += 1
        for k in range(len(before), common, -1):
            done = finish(path.pop())
            path[-1][1].append((before[k - 1], done))
        path.extend([False, []] for _ in range(len(w) - common))
        path[-1][0] = True
        before = w
    for k in range(len(before), 0, -1):
        done = finish(path.pop())
        path[-1][1].append((before[k - 1], done))
    start = finish(path.pop())
    # numbers: states are finished after all that they lead to
    reach = np.zeros(len(arcs), np.int64)
    keys, target, number = [], [], []
    # the start is put first by swapping its number with state 0
    name = lambda s: 0 if s == start else start if s == 0 else s
    for s, out in enumerate(arcs):
        total = int(final[s])
        for byte, t in out:
            keys.append(name(s) << 8 | byte)
            target.append(name(t))
            number.append(total)
            total += int(reach[t])
        reach[s] = total
    ends = np.zeros(len(arcs), bool)
    ends[[name(s) for s, f in enumerate(final) if f]] = True
    slots, at = hashmap.build(np.array(keys, np.int64), np.arange(len(keys), dtype=np.int32))
    return {"slots": slots, "arc": at, "target": np.array(target, np.int32), "number": np.array(number, np.int32), "ends": ends}


def look_up(a: dict[str, np.ndarray], data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place in the word list of each slice of ``data``, -1 where it isn't a word;
    all slices step through the automaton together."""
    out = np.full(len(start), -1, np.int64)
    live = np.arange(len(start))
    state, total, at = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), start.copy()
    if not len(a["ends"]) or not len(a["target"]):
        return out
    while len(live):
        over = at == end[live]
        done = over & a["ends"][state]
        out[live[done]] = total[done]
        go = ~over
        live, state, total, at = live[go], state[go], total[go], at[go]
        arc = hashmap.find((a["slots"], a["arc"]), state << 8 | data[at])
        go = arc >= 0
        live, arc = live[go], arc[go]
        state, total, at = a["target"][arc].astype(np.int64), total[go] + a["number"][arc], at[go] + 1
    return out
