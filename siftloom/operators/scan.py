"""One pass over texts for any number of terms.

Each text is split into words once; terms are looked up in its set of words, so the
cost follows the text, not the vocabulary. What comes out is narrow: flags, counts
and first hits. The optimiser can't move or repeat an Arrow map, so rules, scores
and gates built on its columns never look at a text again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.signals import Composite, Signal, term_pattern
from ..runtime import prepare

_WORD = re.compile(r"\w+")
EVIDENCE = "array<struct<signal:string,field:string,matched:string>>"
_EVIDENCE = pa.list_(pa.struct([("signal", pa.string()), ("field", pa.string()), ("matched", pa.string())]))


@dataclass(frozen=True)
class TermList:
    """Terms whose number in some of the fields (all unless ``fields`` says which) counts."""

    terms: tuple[str, ...]
    fields: tuple[str, ...] | None = None


class _Terms:
    """Terms compiled for look-up in the folded words of a text."""

    def __init__(self, terms: Sequence[str]):
        self.single: dict[str, list[int]] = {}
        self.stems: dict[int, dict[str, list[int]]] = {}
        self.phrases: dict[str, list[tuple[str, int]]] = {}
        for n, term in enumerate(terms):
            words = _WORD.findall(term.casefold())
            if not words:
                continue
            stem = term.endswith("*")
            if len(words) > 1:  # next to each other, whatever stands between
                self.phrases.setdefault(words[0], []).append((" " + " ".join(words) + ("" if stem else " "), n))
            elif stem:
                self.stems.setdefault(len(words[0]), {}).setdefault(words[0], []).append(n)
            else:
                self.single.setdefault(words[0], []).append(n)

    def hits(self, text: str) -> set[int]:
        words = _WORD.findall(text.casefold())
        have = set(words)
        out: list[int] = []
        for w in have & self.single.keys():
            out += self.single[w]
        for size, stems in self.stems.items():
            for w in {w[:size] for w in have} & stems.keys():
                out += stems[w]
        if begun := have & self.phrases.keys():
            joined = " " + " ".join(words) + " "
            out += [n for w in begun for p, n in self.phrases[w] if p in joined]
        return set(out)


def _quote(text: str, term: str) -> str:
    """The term as it stands in the text."""
    m = re.search(re.sub(r"^\(\?[a-zA-Z]+\)", "(?i)", term_pattern(term)), text)
    return m.group(0) if m else term.rstrip("*")


@dataclass(frozen=True)
class Search:
    """What :func:`scan` looks for: ``fields`` name -> column; simple signals;
    named term lists."""

    fields: Mapping[str, str]
    signals: Sequence[Signal | Composite] = ()
    lists: Mapping[str, TermList] = field(default_factory=dict)


def scan(items: DataFrame, search: Search, carry: Sequence[str]) -> DataFrame:
    """The columns ``carry`` of each item, ``on_<signal>`` for each signal,
    ``n_<list>`` (distinct terms that occur) for each list, and ``evidence``: the
    first hit of each simple signal that fires, patterns before keywords, in their
    order, each over the fields in theirs.

    Keywords are whole words in any case, contiguous in a phrase; ``*`` at the end
    stands for any ending. Patterns are regular expressions in which case counts.
    A null text holds nothing. Composite signals follow from the simple ones.
    """
    prepare(items.sparkSession)
    names = list(search.fields)
    simple = [s for s in search.signals if isinstance(s, Signal)]
    patterns = list(dict.fromkeys(p for s in simple for p in s.patterns))
    terms = list(dict.fromkeys([t for s in simple for t in s.keywords] + [t for x in search.lists.values() for t in x.terms]))
    number = {t: n for n, t in enumerate(terms)}
    kept = [f"_k{n}" for n in range(len(carry))]
    given = [F.col(c).alias(k) for c, k in zip(carry, kept)] + [F.col(c).alias(f"_f{n}") for n, c in enumerate(search.fields.values())]
    given += [F.regexp_substr(F.col(c), F.lit(p)).alias(f"_p{i}_{n}") for i, p in enumerate(patterns) for n, c in enumerate(search.fields.values())]
    rows = items.select(*given)
    wanted = [(s.name, s.least, [patterns.index(p) for p in s.patterns], [number[t] for t in dict.fromkeys(s.keywords)]) for s in simple]
    counted = [({number[t] for t in x.terms}, [n for n, f in enumerate(names) if x.fields is None or f in x.fields]) for x in search.lists.values()]
    width, nf = len(kept), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = _Terms(terms)
        for b in batches:
            texts = [b.column(width + n).to_pylist() for n in range(nf)]
            found = [[compiled.hits(t) if t else frozenset() for t in own] for own in texts]
            quoted = [[b.column(width + nf + i * nf + n).to_pylist() for n in range(nf)] for i in range(len(patterns))]
            flags: list[list[bool]] = [[] for _ in wanted]
            counts: list[list[int]] = [[] for _ in counted]
            evidence = []
            for r in range(b.num_rows):
                own = [f[r] for f in found]
                anywhere = set().union(*own)
                first = []
                for k, (name, least, pats, keys) in enumerate(wanted):
                    hit = [i for i in pats if any(q[r] is not None for q in quoted[i])]
                    on = len(hit) + sum(t in anywhere for t in keys) >= least
                    flags[k].append(on)
                    if not on:
                        continue
                    if hit:
                        n = next(n for n in range(nf) if quoted[hit[0]][n][r] is not None)
                        first.append({"signal": name, "field": names[n], "matched": quoted[hit[0]][n][r]})
                    elif t := [t for t in keys if t in anywhere]:
                        n = next(n for n in range(nf) if t[0] in own[n])
                        first.append({"signal": name, "field": names[n], "matched": _quote(texts[n][r], terms[t[0]])})
                evidence.append(first)
                for k, (ids, places) in enumerate(counted):
                    counts[k].append(len(ids & (anywhere if len(places) == nf else set().union(*[own[n] for n in places]))))
            cols = [pa.array(f, pa.bool_()) for f in flags] + [pa.array(c, pa.int32()) for c in counts] + [pa.array(evidence, _EVIDENCE)]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *cols], [*kept, *out_names])

    out_names = [f"_s{k}" for k in range(len(wanted))] + [f"_n{k}" for k in range(len(counted))] + ["_evidence"]
    kinds = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    kinds += [f"{n} {'boolean' if n[1] == 's' else 'int' if n[1] == 'n' else EVIDENCE}" for n in out_names]
    out = rows.mapInArrow(run, ", ".join(kinds)).toDF(*carry, *[f"on_{s.name}" for s in simple], *[f"n_{n}" for n in search.lists], "evidence")
    for s in search.signals:
        if isinstance(s, Composite):
            missing = [n for n in s.all_of if f"on_{n}" not in out.columns]
            if missing:
                raise ValueError(f"{s.name} needs unknown signals {missing}")
            on = F.lit(True)
            for n in s.all_of:
                on = on & F.col(f"on_{n}")
            out = out.withColumn(f"on_{s.name}", on)
    return out
