"""An adaptive context-mixing range coder for sequences of token ids, in numpy.

A block is cut into lanes of equal length that are coded side by side, one id of each lane per step, with one model for
all of them that learns after every step. Three predictors speak: order 2 and order 1 name the id that last followed
the same two ids, or the same id, with a confidence; order 0 has a count of every id. For each pair of confidences the
model counts which of the three was right, and these counts are the weights of the mixture by which the interval of a
lane's range coder is narrowed. The decoder repeats the steps. Each block starts from nothing.

Every lane has a 64-bit range coder that gives out 16-bit words when its width falls below 48 bits. When the word is
given out depends on the width alone; carries into words given out before are added at the end. The words of all lanes
are put in the order in which the decoder takes them.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_TOP, _WORD, _FIRST, _NONE = _U(1 << 48), _U(16), _U(48), _U(0)
_LANE_IDS, _MOST_LANES = 512, 4096
#: Steps after which the sums of the counts are made anew; at first after every step.
_EVERY, _AT_FIRST = 16, 32
_TABLE_BITS, _PLACE_BITS = 20, 14
#: The three predictors share this, each at least one of it.
_SHARES = 1 << 16
#: Sum of the counts at which they are halved; an interval that order 0 divides is never less than 32 bits wide.
_MOST_COUNTED = 1 << 30
#: A guess is its id and, in the lowest three bits, its confidence.
_SURE = 7


def _shape(n: int) -> tuple[int, int]:
    """Lanes, and ids of a lane."""
    lanes = min(max(n // _LANE_IDS, 1), _MOST_LANES)
    length = -(-n // lanes) if n else 0
    return (-(-n // length) if n else 0), length


class _Model:
    def __init__(self, vocabulary: int, lanes: int, places: bool):
        self.steps, self.seen, self.states = 0, [], []
        self.counts, self.ends = np.ones((2, vocabulary), np.int32)
        self.right = np.ones((_SURE + 1) * (_SURE + 1) * 2 * 3, np.int64)
        self.guess1, self.guess2 = np.zeros(vocabulary, np.int32), np.zeros(1 << _TABLE_BITS, np.int32)
        self.last, self.mixed = np.zeros((2, lanes), np.int64)
        self.places = np.zeros((1 << _PLACE_BITS) + 1, np.int64) if places else None

    def _sum(self) -> None:
        if self.seen:
            self.counts += 24 * np.bincount(np.concatenate(self.seen), minlength=len(self.counts)).astype(np.int32)
            self.right += 8 * np.bincount(np.concatenate(self.states), minlength=len(self.right))
            self.seen, self.states = [], []
        total = int(np.cumsum(self.counts, out=self.ends)[-1])
        if total > _MOST_COUNTED:
            self.counts = (self.counts + 1) >> 1
            total = int(np.cumsum(self.counts, out=self.ends)[-1])
        # A little less than one over the sum, so that what it gives times the sum is never more than the width.
        self.one = (1 - 2.0**-50) / total
        upto = np.cumsum(self.right.reshape(-1, 3), axis=1)
        shares = upto[:, :2] * (_SHARES - 3) // upto[:, 2:] + (1, 2)
        self.shares1, self.shares0 = np.ascontiguousarray(shares.T).view(_U)
        if self.places is not None:
            # How many ids end in front of each of the places into which all counts are cut.
            self.cut = max(total.bit_length() - _PLACE_BITS, 0)
            held = np.bincount(self.ends >> self.cut, minlength=len(self.places))
            np.cumsum(held[:-1], out=self.places[1:])

    def find(self, counted: np.ndarray) -> np.ndarray:
        """The ids in whose counts ``counted`` lie."""
        place = counted >> self.cut
        found = self.places.take(place)
        # Right where no id ends within the place.
        some = np.flatnonzero(self.places.take(place + 1) != found)
        found[some] = np.searchsorted(self.ends, counted[some].astype(np.int32), side="right")
        return found

    def predict(self, k: int, width: np.ndarray) -> None:
        """For the first ``k`` lanes: the two named ids, and where in the widths their parts end."""
        if self.steps < _AT_FIRST or self.steps % _EVERY == 0:
            self._sum()
        self.steps += 1
        self.at1 = self.last[:k]
        mixed = self.at1 * 0x9E3779B1
        self.at2 = ((mixed + (self.mixed[:k] >> 13)) >> 7) & ((1 << _TABLE_BITS) - 1)
        self.mixed[:k] = mixed
        self.old1, self.old2 = self.guess1.take(self.at1), self.guess2.take(self.at2)
        self.id1, self.id2 = self.old1 >> 3, self.old2 >> 3
        self.sure1, self.sure2 = self.old1 & _SURE, self.old2 & _SURE
        self.state = ((self.sure2 << 4) | (self.sure1 << 1) | (self.id1 == self.id2)).astype(np.int64)
        share = width >> _WORD
        self.end2, self.end1 = self.shares1.take(self.state) * share, self.shares0.take(self.state) * share

    def each(self, width: np.ndarray) -> np.ndarray:
        """The part of ``width`` that one count of order 0 has."""
        return (width.astype(np.float64) * self.one).astype(_U)

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit2``: order 2 is right; ``hit1``: order 1 is."""
        who = ~hit2 * (np.int8(2) - hit1.view(np.int8))
        self.states.append(self.state * 3 + who)
        self.seen.append(ids)
        new = (ids.astype(np.int32) << 3) | 1
        for guess, at, old, sure, hit in (
            (self.guess1, self.at1, self.old1, self.sure1, hit1),
            (self.guess2, self.at2, self.old2, self.sure2, hit2),
        ):
            wrong = np.where(sure > 1, old - ((sure + 1) >> 1), new)  # a sure one stays with half the confidence
            guess[at] = np.where(hit, old + (sure < _SURE), wrong)
        self.last[: len(ids)] = ids


def encode(ids: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids (each below ``vocabulary``) as 16-bit words."""
    n = len(ids)
    lanes, length = _shape(n)
    if not n:
        return np.zeros(0, np.uint16)
    grid = np.zeros(lanes * length, np.int32)
    grid[:n] = ids
    steps = np.ascontiguousarray(grid.reshape(lanes, length).T)
    del grid
    whole = n - (lanes - 1) * length  # ids of the last lane
    model = _Model(vocabulary, lanes, False)
    lows, widths = np.zeros(lanes, _U), np.full(lanes, ~_NONE)
    most = 4 * length + 4  # words of a lane
    words, given, order = np.zeros(lanes * most, np.uint16), np.arange(lanes) * most, []
    for t in range(length):
        k = lanes if t < whole else lanes - 1
        x, low, width = steps[t, :k].astype(np.int64), lows[:k], widths[:k]
        model.predict(k, width)
        hit2, hit1 = x == model.id2, x == model.id1
        rest = np.flatnonzero(~(hit2 | hit1))
        begin = np.where(hit2, _NONE, np.where(hit1, model.end2, model.end1))
        size = np.where(hit2, model.end2, np.where(hit1, model.end1, width)) - begin
        if len(rest):
            one, named = model.each(size[rest]), x[rest]
            count = model.counts.take(named)
            begin[rest] += one * (model.ends.take(named) - count).astype(_U)
            size[rest] = one * count.astype(_U)
        low += begin
        over = given[np.flatnonzero(low < begin)] - 1
        while len(over):  # a carry goes on where it makes a word zero
            words[over] += np.uint16(1)
            over = over[words[over] == 0] - 1
        width[:] = size
        out = np.flatnonzero(size < _TOP)
        while len(out):
            l, w = low[out], width[out] << _WORD
            at = given[out]
            words[at] = l >> _FIRST
            order.append(at)
            given[out] = at + 1
            low[out] = l << _WORD
            width[out] = w
            out = out[w < _TOP]
        model.learn(x, hit2, hit1)
    for _ in range(4):
        words[given] = lows >> _FIRST
        given += 1
        lows <<= _WORD
    # A decoder holds four words of its lane: at the n-th word given out it takes the word four further on.
    first = words.reshape(lanes, most)[:, :4].T.ravel()
    return np.concatenate((first, words[np.concatenate(order) + 4])) if order else first


def decode(words: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    """The ``n`` ids that encode() turned into ``words``."""
    lanes, length = _shape(n)
    if not n:
        return np.zeros(0, np.int64)
    steps = np.zeros((length, lanes), np.int32)
    whole = n - (lanes - 1) * length
    model = _Model(vocabulary, lanes, True)
    widths, codes = np.full(lanes, ~_NONE), np.zeros(lanes, _U)  # codes: how far into the widths
    at = 0
    for _ in range(4):
        codes = (codes << _WORD) | words[at : at + lanes]
        at += lanes
    for t in range(length):
        k = lanes if t < whole else lanes - 1
        width, code = widths[:k], codes[:k]
        model.predict(k, width)
        hit2 = code < model.end2
        rest = np.flatnonzero(code >= model.end1)
        x = np.where(hit2, model.id2, model.id1)
        begin = np.where(hit2, _NONE, model.end2)
        size = np.where(hit2, model.end2, model.end1) - begin
        if len(rest):
            far = model.end1[rest]
            one, inside = model.each(width[rest] - far), code[rest] - far
            found = model.find(np.minimum((inside // one).view(np.int64), model.ends[-1] - 1))
            count = model.counts.take(found)
            begin[rest] = far + one * (model.ends.take(found) - count).astype(_U)
            size[rest] = one * count.astype(_U)
            x[rest] = found
        code -= begin
        width[:] = size
        out = np.flatnonzero(size < _TOP)
        while len(out):
            w = width[out] << _WORD
            code[out] = (code[out] << _WORD) | words[at : at + len(out)]
            at += len(out)
            width[out] = w
            out = out[w < _TOP]
        model.learn(x, hit2, x == model.id1)
        steps[t, :k] = x
    return steps.T.ravel()[:n].astype(np.int64)
