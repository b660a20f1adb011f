"""Segmentation lattices of many words at once, and sampling from them without replacement.

No piece of the vocabulary has a space mark after another character, so a text's lattice is
a chain of the lattices of its words, and equal words share one. All words of a batch are
built together: the vocabulary trie is walked from every position at once, and the sums over
segmentations are taken position by position.

A segmentation's log probability is the sum of its pieces' scores minus the log of the sum
over all segmentations. Sampling is a best-first search over partial segmentations in text
order, each with a perturbed value: the largest Gumbel-perturbed log probability of its
completions. That value is passed on to one of its continuations, picked with its
probability, and the others get the largest value below it that their own mass draws. The
continuations not taken at a step are one entry of the agenda until it is their turn. So the
k largest perturbed values come out in order, as k distinct segmentations, and the next one
gives the threshold for their inclusion probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortloom.llm.common import GOLDEN, mix64

SPACE = "▁"
_CODE = np.int64(21)  # bits of a code point
_DIRECT = 0x3000  # code points below have their first step in a table


@dataclass
class Pieces:
    """Vocabulary of normal pieces, with byte pieces for characters that have none."""

    text: list[str]  # by id
    score: np.ndarray  # by id
    normal: list[int]
    byte_id: list[int]  # 256 ids
    byte_score: float

    def __post_init__(self):
        edges: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        nodes = 1
        for i in self.normal:
            node = 0
            for c in self.text[i]:
                key = (node, ord(c))
                if key not in edges:
                    edges[key] = nodes
                    nodes += 1
                node = edges[key]
            ends[node] = i
        keys = np.array([n << 21 | c for n, c in edges], np.int64)
        after = np.fromiter(edges.values(), np.int32, len(edges))
        self._fill(keys, after)
        # the node after a first character, for most characters without a search
        self.root = np.full(_DIRECT, -1, np.int32)
        first = keys < _DIRECT
        self.root[keys[first]] = after[first]
        self.piece = np.full(nodes, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())

    def _fill(self, keys: np.ndarray, after: np.ndarray) -> None:
        """A hash table of the trie's edges, a key that finds its place taken goes to the next."""
        bits = (2 * len(keys)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.held = np.full((1 << bits) + len(keys), -1, np.int64)
        self.target = np.full(len(self.held), -1, np.int32)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = np.flatnonzero(self.held[at] < 0)
            where, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.held[where], self.target[where] = keys[left[put]], after[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, at = left[rest], at[rest] + 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, code: np.ndarray, first: bool) -> np.ndarray:
        """The node after a character, -1 where there is none."""
        if first and len(code) and code.max() < _DIRECT:
            return self.root[code]
        key = (state.astype(np.int64) << _CODE) | code
        at = self._place(key)
        held = self.held[at]
        out = np.where(held == key, self.target[at], np.int32(-1))
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            at[open_] += 1
            held = self.held[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.target[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class Lattices:
    """Lattices of words; nodes and edges of all words in common arrays.

    The words are given without the space mark that each begins with. A word of n characters has n + 1 nodes. Edges are sorted by the node they end at, each
    with its probability among the edges that end there.
    """

    def __init__(self, pieces: Pieces, words: pa.Array):
        self.room: dict[str, np.ndarray] = {}  # arrays that the ones below are the beginning of
        # 32 bits for all that counts characters or edges, as there are many of them
        lengths = np.asarray(pc.utf8_length(words)).astype(np.int32) + 1
        whole = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "")
        joined = whole[0].as_py().encode("utf-32-le")
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        begin = np.cumsum(lengths, dtype=np.int32) - lengths  # first character of each word
        marked = np.zeros(len(word), bool)
        marked[begin] = True
        code = np.full(len(word), ord(SPACE), np.int32)
        code[~marked] = np.frombuffer(joined, np.int32)
        self.first = begin + np.arange(len(words), dtype=np.int32)  # node before each word
        self.last = self.first + lengths
        limit = (begin + lengths)[word]
        origins, tails, ids = [], [], []  # first and last character of each edge, its piece
        at = np.arange(len(code), dtype=np.int32)
        origin, state = at, np.zeros(len(code), np.int32)
        while len(at):
            state = pieces.step(state, code[at], first=not ids)
            hit = np.flatnonzero(state >= 0)
            origin, state, at = origin[hit], state[hit], at[hit]
            piece = pieces.piece[state]
            whole = piece >= 0
            origins.append(origin[whole])
            tails.append(at[whole])
            ids.append(piece[whole])
            at = at + 1
            more = at < limit[origin]
            origin, state, at = origin[more], state[more], at[more]
        single = np.zeros(len(code), bool)
        if ids:
            single[origins[0]] = True  # the first round found the pieces of one character
        alone = np.flatnonzero(~single).astype(np.int32)  # characters without a piece: their bytes
        origin = np.concatenate([*origins, alone])
        tail = np.concatenate([*tails, alone])
        ids = np.concatenate([*ids, -1 - code[alone]])
        del origins, tails, single
        spelled = ids < 0
        score = pieces.score[np.maximum(ids, 0)]
        score[spelled] = pieces.byte_score * utf8_width(-1 - ids[spelled])
        # each round found its edges in order, so this sort merges a few ordered runs
        order = np.argsort(tail, kind="stable")
        origin, tail, score = origin[order], tail[order], score[order]
        self.ids = ids[order]
        shift = word[origin]
        self.start, end = origin + shift, tail + shift + 1
        place = tail - begin[shift]  # of the last character in its word
        if len(place) and place.max() < 1 << 16:
            place = place.astype(np.uint16)  # numbers of two bytes are sorted by counting
        del origin, tail, shift, order, ids
        total = np.zeros(int((lengths + 1).sum()))
        order = np.argsort(place, kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(place))).tolist() if len(place) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = order[a:b]
            ends = end[own]
            group = np.flatnonzero(np.diff(ends, prepend=-1))
            value = total[self.start[own]] + score[own]
            top = np.maximum.reduceat(value, group)
            each = np.repeat(top, np.diff(np.append(group, b - a)))
            total[ends[group]] = top + np.log(np.add.reduceat(np.exp(value - each), group))
        self.log_q = np.minimum(total[self.start] + score - total[end], 0.0)
        self.count = np.bincount(end, minlength=len(total)).astype(np.int32)
        self.offset = np.cumsum(self.count, dtype=np.int32) - self.count
        self.q = np.exp(self.log_q)

    def clear(self) -> None:
        """Forget all words; the memory is used again for the next ones."""
        for name in ("first", "last", "start", "offset", "ids", "log_q", "q", "count"):
            self._put(name, 0, getattr(self, name)[:0])

    def extend(self, more: Lattices) -> None:
        """Add the lattices of further words, whose numbers go on from here."""
        nodes, edges = np.int32(len(self.count)), np.int32(len(self.ids))
        for name, shift in (("first", nodes), ("last", nodes), ("start", nodes), ("offset", edges)):
            self._put(name, len(getattr(self, name)), getattr(more, name) + shift)
        for name in ("ids", "log_q", "q", "count"):
            self._put(name, len(getattr(self, name)), getattr(more, name))

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        """Write values behind the first `at` of an array, which has room for more of them."""
        room, n = self.room.get(name, getattr(self, name)), at + len(values)
        if n > len(room):
            room = np.empty(n + n // 2, room.dtype)  # memory is taken where it is written to
            room[:at] = getattr(self, name)[:at]
        room[at:n] = values
        self.room[name] = room
        setattr(self, name, room[:n])

    def end(self, edge: int) -> int:
        """The node that an edge ends at: nodes without edges come before one with the same offset."""
        return int(np.searchsorted(self.offset, np.int32(edge), side="right")) - 1

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge that ends at each node, by its probability."""
        edge = self.offset[node]
        final = edge + self.count[node] - 1
        left = u - self.q[edge]
        open_ = np.flatnonzero((left >= 0) & (edge < final))
        while len(open_):
            edge[open_] += 1
            left[open_] -= self.q[edge[open_]]
            open_ = open_[(left[open_] >= 0) & (edge[open_] < final[open_])]
        return edge


def utf8_width(code: np.ndarray) -> np.ndarray:
    return 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)


def stream(seeds: np.ndarray, kind: int, round_: int) -> np.ndarray:
    """Where each text's random numbers of one kind and round start."""
    return mix64(mix64(seeds + np.uint64(kind)) + np.uint64(round_))


def uniform(start: np.ndarray, counter: np.ndarray | int = 0) -> np.ndarray:
    """The numbers in (0, 1) at places of streams; the same place gives the same number."""
    key = mix64(start + np.asarray(counter).astype(np.uint64) * GOLDEN)
    return ((key >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


@dataclass
class Path:
    """One segmentation of each text, its steps in search order: words from the left, the
    pieces of a word from its right end. Steps before `own` are shared with an older path."""

    text: np.ndarray  # of each step
    bounds: np.ndarray  # of the steps of each text
    word: np.ndarray  # occurrence of a word, by step
    edge: np.ndarray
    before: np.ndarray  # log probability of what comes before the step
    raw: np.ndarray  # perturbed value of the continuations not taken, before the text's cap
    total: np.ndarray  # by text: log probability
    top: np.ndarray  # by text: perturbed value, -inf where there is no such path


def _walk(lattices, texts_at, words_at, node, stop, seeds, round_):
    """(row, edge) of the steps from each row's node back to where its word starts."""
    out = []
    live = np.flatnonzero(node > stop)
    start, place, step = stream(seeds, 1, round_)[texts_at], words_at << 24, 0
    while len(live):
        edge = lattices.pick(node[live], uniform(start[live], place[live] + step))
        out.append((live, edge))
        node[live] = lattices.start[edge]
        live = live[node[live] > stop[live]]
        step += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, edge = (np.concatenate(a) for a in zip(*out, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], edge[order]


def _capped(location, cap, noise):
    """The largest of Gumbel values with that location, given that it is not above `cap`."""
    return -np.logaddexp(-cap, -location + np.log(-np.log(noise)))


def _uncapped(value, cap):
    """What `cap` makes `value` of; it keeps the order, so a text's largest is found before."""
    return value - np.log(-np.expm1(value - cap)) if value < cap else np.inf


def sample(
    lattices: Lattices, sizes: np.ndarray, words: np.ndarray, seeds: np.ndarray, k: int
) -> tuple[list[Path], np.ndarray]:
    """The k largest perturbed segmentations of each text, and each text's next value.

    `words` are the words of all texts, as numbers of words of the lattices; each text has
    as many as `sizes` says.
    """
    n = len(sizes)
    text_of_word = np.repeat(np.arange(n), sizes)
    ends, firsts = lattices.last[words], lattices.first[words]
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    paths: list[Path] = []
    used: dict[tuple[int, int, int], list[int]] = {}  # edges tried at a step, beside its own
    every = np.arange(n)
    top = -np.log(-np.log(uniform(stream(seeds, 0, 0))))
    row, edge = _walk(lattices, text_of_word, place, ends.copy(), firsts, seeds, 0)
    paths.append(
        _path(lattices, n, text_of_word[row], row, edge, np.zeros(n), top, seeds, 0, None)
    )
    for round_ in range(1, k + 1):
        best = np.stack([_largest(p, n) for p in paths])
        source = best.argmax(axis=0)
        value = best[source, every]
        if round_ == k or not np.isfinite(value).any():
            return paths, value
        kept, chosen, base = [], [], np.zeros(n)
        choice, noise = uniform(stream(seeds, 2, round_)), uniform(stream(seeds, 3, round_))
        for t in np.flatnonzero(np.isfinite(value)).tolist():
            old = paths[source[t]]
            a, b = old.bounds[t], old.bounds[t + 1]
            step = a + int(old.raw[a:b].argmax())
            own = int(old.edge[step])
            node = lattices.end(own)
            tried = used.setdefault((int(source[t]), t, step), [own])
            options = range(int(lattices.offset[node]), int(lattices.offset[node] + lattices.count[node]))
            options = [e for e in options if e not in tried]
            weights = np.array([lattices.q[e] for e in options])
            u = choice[t] * weights.sum()
            new = options[min(int(np.searchsorted(np.cumsum(weights), u, side="right")), len(options) - 1)]
            tried.append(new)
            # those still not taken at this step go on with the mass that is left
            left = [lattices.q[e] for e in options if e != new]
            rest = sum(left)
            old.raw[step] = -np.inf
            if left and rest > 0:
                location = old.before[step] + np.log(rest)
                old.raw[step] = _uncapped(_capped(location, value[t], noise[t]), old.top[t])
            kept.append((t, a, step))
            chosen.append(new)
            base[t] = old.before[step] + lattices.log_q[new]
        paths.append(
            _branch(lattices, n, paths, source, kept, chosen, base, value, seeds, round_,
                    words, text_of_word, place, ends, firsts)
        )
    return paths, np.full(n, -np.inf)


def _largest(path: Path, n: int) -> np.ndarray:
    out = np.full(n, -np.inf)
    full = np.flatnonzero(path.bounds[1:] > path.bounds[:-1])
    if len(full):
        raw = np.maximum.reduceat(path.raw, path.bounds[full])
        out[full] = -np.logaddexp(-path.top[full], -raw)
    return out


def _path(lattices, n, text, word, edge, base, top, seeds, round_, head) -> Path:
    """A path of the steps given; `head` marks steps that it shares or branched off at."""
    counts = np.bincount(text, minlength=n)
    bounds = np.append(0, np.cumsum(counts))
    log_q = lattices.log_q[edge].copy()
    if head is not None:
        log_q[head] = 0.0  # counted in `base`
    run = np.cumsum(log_q)
    offset = np.append(0.0, run)[bounds[:-1]]
    before = run - log_q
    before -= np.repeat(offset, counts)
    before += np.repeat(base, counts)
    total = base + np.append(0.0, run)[bounds[1:]] - offset
    rest = -np.expm1(log_q)  # of the other edges; an edge alone has log probability zero
    raw = np.full(len(edge), -np.inf)
    some = np.flatnonzero(rest > 0)
    owner = text[some]
    noise = uniform(stream(seeds, 4, round_)[owner], some - bounds[owner])
    raw[some] = before[some] + np.log(rest[some] / -np.log(noise))
    return Path(text, bounds, word, edge, before, raw, total, top)


def _branch(
    lattices, n, paths, source, kept, chosen, base, value, seeds, round_, words, text_of_word,
    place, ends, firsts,
) -> Path:
    """The paths that leave an older one at a step, with new steps after it."""
    heads_t, heads_w, heads_e = [], [], []
    from_word = np.full(n, len(words), np.int64)  # occurrences from here on are walked anew
    rows_t, rows_w, rows_node = [], [], []
    for (t, a, step), new in zip(kept, chosen, strict=True):
        old = paths[source[t]]
        heads_t.append(np.full(step - a + 1, t))
        heads_w.append(old.word[a : step + 1])
        heads_e.append(np.append(old.edge[a:step], new))
        from_word[t] = old.word[step] + 1
        rows_t.append(t)
        rows_w.append(old.word[step])
        rows_node.append(lattices.start[new])
    later = np.flatnonzero(np.arange(len(words)) >= from_word[text_of_word])
    text = np.concatenate([np.array(rows_t, np.int64), text_of_word[later]])
    word = np.concatenate([np.array(rows_w, np.int64), later])
    node = np.concatenate([np.array(rows_node, np.int64), ends[later]])
    # the rest of the word in which a path left is walked like a word of its own
    row, edge = _walk(lattices, text, place[word], node, firsts[word], seeds, round_)
    all_t = np.concatenate([*heads_t, text[row]])
    all_w = np.concatenate([*heads_w, word[row]])
    all_e = np.concatenate([*heads_e, edge])
    is_head = np.zeros(len(all_t), bool)
    is_head[: sum(map(len, heads_t))] = True
    order = np.argsort(all_t, kind="stable")  # in a text the words are in order
    top = np.where(np.isfinite(value), value, -np.inf)
    return _path(
        lattices, n, all_t[order], all_w[order], all_e[order], base, top, seeds, round_,
        is_head[order],
    )


def edges_in_text_order(path: Path) -> np.ndarray:
    """Step numbers of all texts, the pieces of each word from the left."""
    if not len(path.word):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(path.word, prepend=-1))
    length = np.diff(np.append(first, len(path.word)))
    place = np.arange(len(path.word)) - np.repeat(first, length)
    return np.repeat(first + length - 1, length) - place


def log_inclusion(total: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Log probability that a segmentation's perturbed value is above the threshold."""
    gap = total - threshold
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.minimum(gap, 700)))))
