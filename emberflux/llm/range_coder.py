"""An adaptive context-mixing range coder for blocks of token ids.

An id is coded in one or two decisions. First: is it the id that last followed the two ids before (order 2),
else the one that last followed the id before (order 1), or another one? Four adaptive models tell the chances: by
the confidence of order 2, by that of order 1 and whether both agree, by the last outcomes, and by all of these.
They are mixed with weights that follow their share in what came true. Another id is coded by order 0, the adaptive
frequencies of such ids.

A block's ids are cut into lanes that run side by side, position by position, so that one numpy operation serves them
all; they share the models, which are brought up to date after some positions. Nothing is shared between blocks.
Every number that decides about a bit is an integer, or a product or quotient of doubles rounded once, so encoder and
decoder agree on every machine.
"""

from __future__ import annotations

import numpy as np

#: Bits of the first decision's chances and of the second's.
BITS1, BITS0 = 16, 19
#: Bits of the slots for predictions of order 1 and 2, and of the ids that order 0 tells apart; lower bits are coded evenly.
SLOTS1, SLOTS2, KNOWN = 16, 18, 16
#: Positions between two updates of the models, at most; a block starts with shorter ones.
EVERY1, EVERY0 = 8, 64
_U, _W = np.uint64, np.uint32
_LOW, _TOP = _U((1 << 32) - 1), _U(1 << 32)
_SURE2, _SURE1, _PAST = 8, 16, 27


class Writer:
    """Range encoders in lanes: 48-bit ranges, 16-bit words, carries settled at the end."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, 1 << 48, _U)
        self.who, self.what = [], []

    def put(self, at: np.ndarray | None, first: np.ndarray, count: np.ndarray, bits: int) -> None:
        """Narrow the ranges of the lanes `at` (None: the first ones) to `count` parts of 2^bits from `first` on."""
        n = len(first)
        unit = (self.range[:n] if at is None else self.range.take(at)) >> _U(bits)
        low = (self.low[:n] if at is None else self.low.take(at)) + unit * first
        wide = unit * count
        small = np.flatnonzero(wide < _TOP)
        if len(small):
            own = low.take(small)
            self.who.append(small if at is None else at.take(small))
            self.what.append((own >> _U(32)).astype(_W))
            low[small] = (own & _LOW) << _U(16)
            wide[small] = wide.take(small) << _U(16)
        if at is None:
            self.low[:n], self.range[:n] = low, wide
        else:
            self.low[at], self.range[at] = low, wide

    def words(self) -> list[np.ndarray]:
        """The 16-bit words of each lane."""
        lanes = len(self.low)
        for _ in range(3):
            self.who.append(np.arange(lanes))
            self.what.append((self.low >> _U(32)).astype(_W))
            self.low = (self.low & _LOW) << _U(16)
        who = np.concatenate(self.who).astype(np.uint16 if lanes < 1 << 16 else _W)
        words = np.concatenate(self.what)[np.argsort(who, kind="stable")]
        while (over := np.flatnonzero(words >> 16)).size:
            # A lane's first word can't overflow: its low end stays below 1.
            words[over] &= _W(0xFFFF)
            np.add.at(words, over - 1, _W(1))
        return np.split(words.astype("<u2"), np.cumsum(np.bincount(who, minlength=lanes))[:-1])


class Reader:
    def __init__(self, words: list[np.ndarray]):
        self.flat = np.concatenate([*words, np.zeros(4, "<u2")]).astype(_U)
        self.at = np.cumsum([0, *map(len, words)])[:-1]
        self.value, self.range = np.zeros(len(words), _U), np.full(len(words), 1 << 48, _U)
        for _ in range(3):
            self.value = (self.value << _U(16)) | self.flat.take(self.at)
            self.at = self.at + 1
        self.end = len(self.flat) - 1

    def place(self, at: np.ndarray | None, n: int, bits: int) -> np.ndarray:
        """The part of 2^bits that each lane's value lies in."""
        self.unit, self.own = (self.range[:n] >> _U(bits), self.value[:n]) if at is None else (self.range.take(at) >> _U(bits), self.value.take(at))
        return np.minimum((self.own // self.unit).view(np.int64), (1 << bits) - 1)

    def take(self, at: np.ndarray | None, first: np.ndarray, count: np.ndarray) -> None:
        """Narrow the ranges as the encoder did."""
        value, wide = self.own - self.unit * first, self.unit * count
        small = np.flatnonzero(wide < _TOP)
        if len(small):
            who = small if at is None else at.take(small)
            where = np.minimum(self.at.take(who), self.end)
            value[small] = (value.take(small) << _U(16)) | self.flat.take(where)
            wide[small] = wide.take(small) << _U(16)
            self.at[who] = where + 1
        if at is None:
            self.value[: len(value)], self.range[: len(wide)] = value, wide
        else:
            self.value[at], self.range[at] = value, wide


class _Choice:
    """Chances of the first decision in each joint state, as cuts of 2^BITS1."""

    def __init__(self):
        self.seen = [np.zeros((n, 3)) for n in (_SURE2, _SURE1, _PAST, _SURE2 * _SURE1 * _PAST)]
        self.weight = np.full(4, 0.25)
        self._mix()

    def _mix(self) -> None:
        prior = np.array([0.3, 0.1, 0.6])
        self.own = []
        for seen, shape in zip(self.seen, ((_SURE2, 1, 1), (1, _SURE1, 1), (1, 1, _PAST), (_SURE2, _SURE1, _PAST))):
            total = seen[:, 0] + seen[:, 1] + seen[:, 2]
            self.own.append(np.stack([(seen[:, k] + 2 * prior[k]) / (total + 2) for k in range(3)], 1).reshape(*shape, 3))
        w, own = self.weight, self.own
        self.mixed = own[0] * w[0] + own[1] * w[1] + own[2] * w[2] + own[3] * w[3]
        most = (1 << BITS1) - 64
        hit2 = (self.mixed[..., 0] * most).astype(np.int64).ravel() + 16
        hit1 = (self.mixed[..., 1] * most).astype(np.int64).ravel() + 16
        self.cut2, self.cut1 = hit2, hit2 + hit1
        zero = np.zeros_like(hit2)
        self.first = np.stack([zero, hit2, self.cut1], 1).ravel().astype(_U)
        self.count = np.stack([hit2, hit1, (1 << BITS1) - self.cut1], 1).ravel().astype(_U)

    def learn(self, codes: list[np.ndarray]) -> None:
        """`codes` are 3 x state + outcome."""
        new = np.bincount(np.concatenate(codes), minlength=3 * _SURE2 * _SURE1 * _PAST).reshape(_SURE2, _SURE1, _PAST, 3)
        # Each model's share in what came true, in integers, as the order of a sum of doubles is not fixed.
        shares = [int((new * (self.weight[k] * self.own[k] / self.mixed * (1 << 20)).astype(np.int64)).sum()) for k in range(4)]
        self.weight = 0.9 * self.weight + 0.1 * np.array([(x + 1) / (sum(shares) + 4) for x in shares])
        for seen, axes in zip(self.seen, ((1, 2), (0, 2), (0, 1), ())):
            seen += new.sum(axes).reshape(-1, 3)
            seen[seen[:, 0] + seen[:, 1] + seen[:, 2] > 4096] *= 0.5
        self._mix()


class _Order0:
    """Frequencies of the ids that no prediction met; each id keeps a part of 2^BITS0."""

    def __init__(self, n: int, reading: bool):
        self.n, self.reading, self.seen = n, reading, np.zeros(n, np.int64)
        self._share()

    def _share(self) -> None:
        free = (1 << BITS0) - self.n
        scaled = self.seen * 32 + 1
        count = 1 + scaled * free // int(scaled.sum())
        count[int(np.argmax(count))] += (1 << BITS0) - int(count.sum())
        first = np.cumsum(count) - count
        self.first, self.count = first.astype(_U), count.astype(_U)
        if self.reading:
            self.id_at = np.repeat(np.arange(self.n, dtype=np.uint16), count)

    def learn(self, ids: list[np.ndarray]) -> None:
        self.seen += np.bincount(np.concatenate(ids), minlength=self.n)
        if int(self.seen.sum()) > 1 << 22:
            self.seen >>= 1
        self._share()


def run(coder: Writer | Reader, lengths: np.ndarray, limit: int, ids: np.ndarray | None = None) -> np.ndarray:
    """Code `ids` or decode; rows are positions, columns are lanes in order of falling length; ids are below `limit`."""
    lanes = len(lengths)
    even = max(0, (limit - 1).bit_length() - KNOWN)
    choice, order0 = _Choice(), _Order0((max(limit, 1) - 1 >> even) + 1, ids is None)
    after1, after2 = np.zeros(1 << SLOTS1, _W), np.zeros(1 << SLOTS2, _W)
    one, two, past = np.zeros(lanes, _W), np.zeros(lanes, _W), np.zeros(lanes, _W)
    out = np.empty((int(lengths.max(initial=0)), lanes), _W) if ids is None else ids
    active = np.searchsorted(-lengths, -np.arange(len(out)), "left").tolist()
    codes, others, next1, next0 = [], [], 1, 1
    for t, n in enumerate(active):
        a, b = one[:n], two[:n]
        at1 = (a * _W(0x9E3779B1) >> _W(32 - SLOTS1)).astype(np.int64)
        at2 = ((a * _W(0x85EBCA6B) ^ b * _W(0xC2B2AE35)) * _W(0x27D4EB2F) >> _W(32 - SLOTS2)).astype(np.int64)
        e1, e2 = after1.take(at1), after2.take(at2)
        guess1, guess2 = e1 >> _W(3), e2 >> _W(3)
        sure1, sure2 = e1 & _W(7), e2 & _W(7)
        state = (sure2 * _W(_SURE1 * _PAST) + (sure1 << _W(1) | (guess1 == guess2)) * _W(_PAST) + past[:n]).astype(np.int64)
        if ids is None:
            place = coder.place(None, n, BITS1)
            symbol = (place >= choice.cut2.take(state)).view(np.int8) + (place >= choice.cut1.take(state)).view(np.int8)
            code = state * 3 + symbol
            coder.take(None, choice.first.take(code), choice.count.take(code))
            x = out[t, :n]
            np.copyto(x, guess2)
            np.copyto(x, guess1, where=symbol == 1)
        else:
            x = ids[t, :n]
            symbol = (x != guess2).view(np.int8) * (np.int8(2) - (x == guess1).view(np.int8))
            code = state * 3 + symbol
            coder.put(None, choice.first.take(code), choice.count.take(code), BITS1)
        rest = np.flatnonzero(symbol == 2)
        if len(rest):
            if ids is None:
                new = known = order0.id_at.take(coder.place(rest, 0, BITS0))
                coder.take(rest, order0.first.take(known), order0.count.take(known))
                if even:
                    low = coder.place(rest, 0, even)
                    coder.take(rest, low.view(_U), np.ones(len(rest), _U))
                    new = known.astype(_W) << _W(even) | low.astype(_W)
                x[rest] = new
            else:
                new = x.take(rest)
                known = new >> _W(even)
                coder.put(rest, order0.first.take(known), order0.count.take(known), BITS0)
                if even:
                    coder.put(rest, (new & _W((1 << even) - 1)).astype(_U), np.ones(len(rest), _U), even)
            others.append(known)
        # A prediction that comes true gains confidence, up to 7; order 1 is replaced once it has none left.
        fresh = x << _W(3)
        hit1, hit2 = x == guess1, x == guess2
        after1[at1] = np.where(hit1, fresh | np.minimum(sure1 + _W(1), _W(7)), np.where(sure1 > _W(2), e1 - _W(2), fresh))
        after2[at2] = np.where(hit2, fresh | np.minimum(sure2 + _W(1), _W(7)), fresh)
        two[:n] = a
        one[:n] = x
        past[:n] = past[:n] % _W(9) * _W(3) + symbol.view(np.uint8)
        codes.append(code)
        if t + 1 >= next1:
            choice.learn(codes)
            codes, next1 = [], t + 1 + min(t + 1, EVERY1)
        if t + 1 >= next0:
            if others:
                order0.learn(others)
            others, next0 = [], t + 1 + min(t + 1, EVERY0)
    return out
