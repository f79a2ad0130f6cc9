"""Hidden Markov model over symbols: scaled recursions for many sequences at a time.

A long sequence is cut into pieces that are gone through side by side. What a piece makes of
each state it may be entered in is found first; from that follow, piece by piece, the states at
all cuts, and the recursions within the pieces start from those.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PIECE = 256  # symbols of a sequence that are gone through one after another


@dataclass(frozen=True)
class Hmm:
    begin: np.ndarray  # by state
    move: np.ndarray  # state x state
    emit: np.ndarray  # symbol x state


class Steps:
    """Sequences laid out by time: at each step the longest ones first, so those that
    go on are a prefix of those before."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        sorted_ = lengths[self.order]
        longest = int(sorted_[0]) if len(sorted_) else 0
        # Sequences that have a symbol at each step.
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        self.ranks = np.empty(len(lengths), np.int64)
        self.ranks[self.order] = np.arange(len(lengths))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.begin[step] + self.ranks[owner]
        self.rank = np.arange(self.begin[-1]) - np.repeat(self.begin[:-1], self.active)
        self.ends = self.begin[lengths - 1] + self.ranks  # by sequence

    def lay(self, symbols: np.ndarray) -> np.ndarray:
        out = np.empty_like(symbols)
        out[self.place] = symbols
        return out

    def each(self) -> list[tuple[int, int]]:
        """Per step its first place and how many sequences have it."""
        return list(zip(self.begin.tolist(), self.active.tolist(), strict=False))


class Pieces:
    """Sequences cut into a head and, of long ones, further pieces in their order."""

    def __init__(self, lengths: np.ndarray) -> None:
        further = (lengths - 1) // PIECE
        self.owner = np.repeat(np.arange(len(lengths)), further)
        self.turn = np.arange(len(self.owner)) - np.repeat(np.cumsum(further) - further, further)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.in_heads = place < PIECE
        self.heads = Steps(np.minimum(lengths, PIECE))
        self.rest = Steps(np.minimum(lengths[self.owner] - (self.turn + 1) * PIECE, PIECE))

    def turns(self) -> list[np.ndarray]:
        """The further pieces that come first in their sequences, those that come second, and so on."""
        by_turn = np.argsort(self.turn, kind="stable")
        return np.split(by_turn, np.cumsum(np.bincount(self.turn))[:-1]) if len(by_turn) else []

    def before(self, of_heads: np.ndarray, of_rest: np.ndarray) -> np.ndarray:
        """Of each further piece the column of the piece before it."""
        out = np.empty((len(of_heads), len(self.owner)), of_heads.dtype)
        out[:, 1:] = of_rest[:, :-1]
        first = self.turn == 0
        out[:, first] = of_heads[:, self.owner[first]]
        return out


@dataclass
class Part:
    """Heads or further pieces with their scaled forward variables (state x place)."""

    steps: Steps
    laid: np.ndarray
    emitted: np.ndarray
    alpha: np.ndarray
    scale: np.ndarray


def _emitted(model: Hmm, laid: np.ndarray, kind: type) -> np.ndarray:
    return np.take(np.ascontiguousarray(model.emit.T, kind), laid, axis=1)


def _forward(
    model: Hmm, steps: Steps, laid: np.ndarray, emitted: np.ndarray, start: np.ndarray
) -> Part:
    """``start``: the states' probabilities at the first place, one column or one per sequence."""
    kind = emitted.dtype
    step = np.ascontiguousarray(model.move.T, kind)
    alpha = np.empty_like(emitted)
    scale = np.empty(len(laid), kind)
    before = 0
    for at, n in steps.each():
        now, total = alpha[:, at : at + n], scale[at : at + n]
        if at:
            np.matmul(step, alpha[:, before : before + n], out=now)
            now *= emitted[:, at : at + n]
        else:
            np.multiply(start.astype(kind), emitted[:, :n], out=now)
        np.add.reduce(now, axis=0, out=total)
        now /= total
        before = at
    return Part(steps, laid, emitted, alpha, scale)


def _transfers(model: Hmm, steps: Steps, emitted: np.ndarray) -> np.ndarray:
    """What each sequence makes of each state at its first place (first state x last state x
    sequence), each sequence's to a scale of its own."""
    kind, states = emitted.dtype, len(model.move)
    step = np.ascontiguousarray(model.move.T, kind)
    out = np.zeros((states, states, len(steps.order)), kind)
    out[:] = np.eye(states, dtype=kind)[:, :, None]
    for at, n in steps.each():
        now = np.matmul(step, out[:, :, :n]) if at else out[:, :, :n]
        now = now * emitted[:, at : at + n]
        now /= np.add.reduce(now, axis=(0, 1))
        out[:, :, :n] = now
    return out[:, :, steps.ranks].astype(np.float64)


def _parts(
    model: Hmm, pieces: Pieces, symbols: np.ndarray, kind: type
) -> tuple[Part, Part | None, np.ndarray | None]:
    """Forward variables of the heads, of the further pieces, and what those make of each state."""
    laid = pieces.heads.lay(symbols[pieces.in_heads])
    heads = _forward(model, pieces.heads, laid, _emitted(model, laid, kind), model.begin[:, None])
    if not len(pieces.owner):
        return heads, None, None
    laid = pieces.rest.lay(symbols[~pieces.in_heads])
    emitted = _emitted(model, laid, kind)
    made = _transfers(model, pieces.rest, emitted)
    reached = heads.alpha[:, pieces.heads.ends].astype(np.float64)
    start = np.empty((len(model.begin), len(pieces.owner)))
    for some in pieces.turns():
        start[:, some] = model.move.T @ reached[:, pieces.owner[some]]
        last = np.einsum("fls,fs->ls", made[:, :, some], start[:, some])
        reached[:, pieces.owner[some]] = last / last.sum(axis=0)
    rest = _forward(model, pieces.rest, laid, emitted, start[:, pieces.rest.order])
    return heads, rest, made


def log10_likelihood(model: Hmm, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each sequence (none may be empty)."""
    pieces = Pieces(lengths)
    heads, rest, _ = _parts(model, pieces, symbols, np.float64)

    def by_sequence(part: Part) -> np.ndarray:
        out = np.empty(len(part.steps.order))
        sums = np.bincount(part.steps.rank, np.log10(part.scale), minlength=len(out))
        out[part.steps.order] = sums
        return out

    out = by_sequence(heads)
    if rest is not None:
        out += np.bincount(pieces.owner, by_sequence(rest), minlength=len(out))
    return out


def _tails(
    model: Hmm, pieces: Pieces, heads: Part, rest: Part, made: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Backward variables at the ends of heads and further pieces, from the pieces after them."""
    end = heads.alpha[:, pieces.heads.ends].astype(np.float64)
    end_of_rest = rest.alpha[:, pieces.rest.ends].astype(np.float64)
    reached = pieces.before(end, end_of_rest)
    of_heads, of_rest = np.ones_like(end), np.ones_like(end_of_rest)
    for turn, some in reversed(list(enumerate(pieces.turns()))):
        back = model.move @ np.einsum("fls,ls->fs", made[:, :, some], of_rest[:, some])
        back /= (reached[:, some] * back).sum(axis=0)
        if turn:
            of_rest[:, some - 1] = back
        else:
            of_heads[:, pieces.owner[some]] = back
    return of_heads, of_rest


def _backward(model: Hmm, part: Part, tails: np.ndarray | None) -> np.ndarray:
    """Scaled backward variables. What each place hands back to the one before it is left in
    ``emitted``."""
    steps, emitted = part.steps, part.emitted
    emitted /= part.scale
    beta = np.ones_like(emitted)
    # A sequence that ends at a place hands back its emission alone.
    if tails is not None:
        beta[:, steps.ends] = tails
        emitted[:, steps.ends] *= tails.astype(emitted.dtype)
    back = np.ascontiguousarray(model.move, emitted.dtype)
    begins, active = steps.begin.tolist(), steps.active.tolist()
    for t in range(len(active) - 2, -1, -1):
        at, go, after = begins[t], active[t + 1], begins[t + 1]
        own = beta[:, at : at + go]
        np.matmul(back, emitted[:, after : after + go], out=own)
        emitted[:, at : at + go] *= own
    return beta


def expected_counts(
    model: Hmm, symbols: np.ndarray, lengths: np.ndarray, kind: type = np.float64
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of the sequences: beginnings, moves, emissions. ``kind`` is what the
    variables of each place are held in; counts are added up in double precision."""
    states = len(model.begin)
    begin, move = np.zeros(states), np.zeros((states, states))
    emit = np.zeros(model.emit.shape)
    if not len(lengths):
        return begin, move, emit
    pieces = Pieces(lengths)
    heads, rest, made = _parts(model, pieces, symbols, kind)
    tails, tails_of_rest = (None, None) if rest is None else _tails(model, pieces, heads, rest, made)
    parts = [(heads, tails)] + ([] if rest is None else [(rest, tails_of_rest)])
    betas = [_backward(model, part, end) for part, end in parts]
    if rest is not None:
        # From the end of a piece to the beginning of the one after it.
        reached = pieces.before(heads.alpha[:, pieces.heads.ends], rest.alpha[:, pieces.rest.ends])
        move += reached @ rest.emitted[:, pieces.rest.ranks].T
    for (part, _), beta in zip(parts, betas, strict=True):
        steps, alpha = part.steps, part.alpha
        # Place ``n`` steps on in the same sequence, for all that go on.
        first = int(steps.active[0])
        earlier = steps.rank[first:] + np.repeat(steps.begin[:-2], steps.active[1:])
        move += np.take(alpha, earlier, axis=1) @ part.emitted[:, first:].T
        alpha *= beta
        for k in range(states):
            emit[:, k] += np.bincount(part.laid, alpha[k], minlength=len(emit))
    move *= model.move
    begin += heads.alpha[:, : pieces.heads.active[0]].sum(axis=1, dtype=np.float64)
    return begin, move, emit
