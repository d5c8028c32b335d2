"""Token ids of whole texts by a vocabulary file of the tokenizers library.

``Encoder`` cuts a whole block of texts in Arrow, looks its units up in a memory of arrays, and
gathers the ids of the block without a loop over its words. ``WordwiseEncoder`` looks up word by
word; other kinds of encoders build on it.

The library encodes words, each once per worker (see ``wordcache``), and the ids of a text are put
together from its words'. That equals encoding the text at once where no token can cross the cut:
a vocabulary whose pieces never hold white space is cut at every space, one whose pieces start
with a space only before a space between two other characters. A line break between words, and a
full stop or comma after letters and digits, are tokens of their own in both. New words are
encoded many at a time, as one text in which their tokens can be told apart. Strings of special
tokens in a text are ordinary text. An empty text has no ids.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from cohortum.llm.wordcache import BETWEEN, Words, release

MARK, CUT, END = "\x01", "\x00", "\x02"
WORD_END = "</w>"
# Units remembered, some 50 bytes each, and the bytes of them and their ids.
UNITS, UNIT_BYTES, AT_ONCE = 800_000, 64 << 20, 16384
LONG, MIX = 64, np.uint64(0x9E3779B97F4A7C15)
LOW_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], dtype=np.uint64)
# White space other than single spaces and line breaks between other characters.
UNUSUAL = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")
TWICE, SELDOM = ("  ", "\n\n", " \n", "\n "), "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
BREAK = re.compile(r"(?<=\S)\n(?=\S)")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
ALPHA = np.array([chr(c).isalpha() and c < 128 for c in range(256)])


def unusual(text: str) -> bool:
    """``UNUSUAL.search`` in a few fast searches."""
    if text[:1].isspace() or text[-1:].isspace() or any(x in text for x in TWICE) or any(c in text for c in SELDOM):
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return UNUSUAL.search(text) is not None
    return False


def with_stops_cut(data: bytes) -> bytes:
    """A mark before full stops and commas that follow an ASCII letter or digit, or a letter from
    À to ÿ: they start a token there."""
    marked = np.frombuffer(data.replace(b",", b"\0,").replace(b".", b"\0."), np.uint8)
    at = np.flatnonzero(marked == 0)
    at = at[at < len(marked) - 1]
    after = marked[at + 1]
    at = at[(after == 44) | (after == 46)]
    before, lead = marked[np.maximum(at - 1, 0)], marked[np.maximum(at - 2, 0)]
    latin = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    kept = np.ones(len(marked), dtype=bool)
    kept[at[~(ALNUM[before] | latin) | (at == 0)]] = False
    return marked[kept].tobytes()


class WordwiseEncoder:
    """Ids as little-endian unsigned 32-bit integers, one bytes object per text."""

    def __init__(self, leading_space: bool):
        self.leading_space = leading_space
        family = f"encoder {id(self)}"
        self.parts = Words(self.encoded, family=family)
        self.first = Words(self.encoded, 50_000, family)
        self.later = Words(self.after_space, family=family)

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of any texts."""
        raise NotImplementedError

    def cut(self, word: str) -> list[str]:
        """The word in parts that share no token."""
        lead = " " if self.leading_space else ""
        out: list[str] = []
        for line in word.split("\n") if "\n" in word else (word,):
            if not line or line[0].isspace() or line[-1].isspace():
                return [lead + word]
            if out:
                out.append("\n")
                lead = ""
            body, mark = (line[:-1], line[-1]) if line[-1] in ",." else (line, "")
            if mark and not body.isalnum():
                body, mark = line, ""
            if not self.leading_space and body.isascii():
                body = body.lower()
            out.append(lead + body)
            if mark:
                out.append(mark)
        return out

    def after_space(self, words: list[str]) -> list[bytes | None]:
        """Ids of words with the space before them; none for words at which no cut is safe."""
        cuts = [
            self.cut(w) if not self.leading_space or (w and not (w[0].isspace() or w[-1].isspace())) else None
            for w in words
        ]
        known = self.parts.learn([parts for parts in cuts if parts])
        return [
            None if parts is None else known(parts[0]) if len(parts) == 1 else b"".join(map(known, parts))
            for parts in cuts
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        rows = [text.split(" ") for text in texts]
        if not self.leading_space:
            known = self.later.learn(rows)
            return [b"".join(map(known, row)) for row in rows]
        head = self.first.learn([[row[0]] for row in rows])
        tail = self.later.learn([row[1:] for row in rows])
        out = []
        for text, row in zip(texts, rows):
            try:
                if row[0][-1:].isspace() or not row[0]:
                    raise TypeError
                out.append(b"".join([head(row[0]), *map(tail, row[1:])]))
            except TypeError:  # a word without safe cuts
                parts = BETWEEN.split(text)
                out.append(b"".join(self.encoded([parts[0], *(" " + p for p in parts[1:])])))
        return out


Found = tuple[np.ndarray, np.ndarray]  # ids of units one after the other, and their numbers


def hashes(units: pa.Array) -> np.ndarray:
    """64-bit hashes of binary values: those of up to ``LONG`` bytes eight bytes of all at a time."""
    ends = np.frombuffer(units.buffers()[1], np.int64)[units.offset : units.offset + len(units) + 1]
    data = (units.buffers()[2] or b"")[int(ends[0]) : int(ends[-1])]
    places, sizes = ends[:-1] - ends[0], np.diff(ends)
    out, padded = sizes.astype(np.uint64), bytes(data) + bytes(8)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    rows, at, left = np.arange(len(units)), places, np.where(sizes > LONG, 0, sizes)
    while len(rows):
        mixed = (out[rows] ^ (eight[at] & LOW_BYTES[np.minimum(left, 8)])) * MIX
        out[rows] = mixed ^ (mixed >> np.uint64(29))
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for row in np.flatnonzero(sizes > LONG).tolist():
        out[row] = xxhash.xxh3_64_intdigest(padded[places[row] : places[row] + sizes[row]])
    return out


class Units(Words):
    """A memory of units and their ids in arrays, without an object for each unit.

    Units are looked up by their hashes, and a unit found is compared, so that two units of one
    hash stay apart. ``END`` is the first and has no ids. A full memory keeps the units that two
    blocks have had.
    """

    def __init__(self, most: int = UNITS, most_bytes: int = UNIT_BYTES):
        super().__init__(list, most)
        self.most_bytes = most_bytes
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([END.encode()], pa.large_binary())
        self.ids, self.sizes = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        self.sort()

    def sort(self) -> None:
        self.starts, self.times = np.cumsum(self.sizes) - self.sizes, np.zeros(len(self.sizes), dtype=np.uint8)
        found = hashes(self.known)
        # In the order of their hashes; of equal ones the oldest, and so ``END``, comes first.
        self.rows = np.argsort(found, kind="stable").astype(np.int32)
        self.hashes = found[self.rows]

    def full(self) -> bool:
        return len(self.known) > self.most or self.known.nbytes + self.ids.nbytes > self.most_bytes

    def thin(self) -> None:
        self.times[0] = 2
        kept = np.flatnonzero(self.times > 1)
        self.ids = self.gathered(kept)
        self.known, self.sizes = self.known.take(pa.array(kept)), self.sizes[kept]
        if 2 * len(kept) > self.most or 2 * (self.known.nbytes + self.ids.nbytes) > self.most_bytes:
            self.forget()
        else:
            self.sort()

    def gathered(self, rows: np.ndarray) -> np.ndarray:
        """The ids of known units, one after the other."""
        many = self.sizes[rows]
        place = np.repeat(self.starts[rows] - (np.cumsum(many) - many), many)
        place += np.arange(len(place))
        return self.ids[place]

    def learn(self, units: pa.Array, compute: Callable[[pa.Array], Found]) -> np.ndarray:
        """Rows of all ``units`` in this memory; ``compute`` works out the ids of new ones."""
        if Words.in_use != self.family:
            release()
            Words.in_use = self.family
        if self.full():
            self.thin()
        coded = units.dictionary_encode()
        distinct, found = coded.dictionary, hashes(coded.dictionary)
        order, at = np.argsort(found), np.empty(len(distinct), dtype=np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, found[order]), len(self.hashes) - 1)
        rows = self.rows[at]
        same = pc.equal(self.known.take(pa.array(rows)), distinct).to_numpy(zero_copy_only=False)
        if not same.all():
            new = np.flatnonzero(~same)
            fresh = distinct.take(pa.array(new))
            ids, sizes = compute(fresh)
            rows[new] = np.arange(len(self.known), len(self.known) + len(new))
            new = new[np.argsort(found[new])]
            before = np.searchsorted(self.hashes, found[new], side="right")
            self.hashes, self.rows = np.insert(self.hashes, before, found[new]), np.insert(self.rows, before, rows[new])
            self.starts = np.append(self.starts, np.cumsum(sizes) - sizes + len(self.ids))
            self.sizes, self.ids = np.append(self.sizes, sizes), np.append(self.ids, ids)
            self.known = pa.concat_arrays([self.known, fresh])
            self.times = np.append(self.times, np.zeros(len(new), dtype=np.uint8))
        self.times[rows] = np.minimum(self.times[rows] + 1, 2)
        return rows[coded.indices.to_numpy()]


def runs(units: pa.Array, between: bytes) -> Iterator[tuple[str, int]]:
    """Units joined, not too many at a time, and their number."""
    for start in range(0, len(units), AT_ONCE):
        some = units.slice(start, AT_ONCE).to_pylist()
        yield between.join(some).decode(), len(some)


def letters_only(units: pa.Array) -> np.ndarray:
    """Units of ASCII letters and letters from À to ÿ alone."""
    ends = np.frombuffer(units.buffers()[1], np.int64)[units.offset : units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    before = np.append(np.uint8(0), data[:-1])[: len(data)]
    letter = ALPHA[data] | (data == 0xC3)
    letter |= (before == 0xC3) & (data != 0x97) & (data != 0xB7)
    others = np.append(0, np.cumsum(~letter))[ends - ends[0]]
    return (np.diff(others) == 0) & (np.diff(ends) > 0)


class Encoder(WordwiseEncoder):
    """By the tokenizers library."""

    def __init__(self, path: str, leading_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(leading_space)
        self.units = Units()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        # Tokens that start a word: those with the space before it, or the mark put between words.
        vocabulary, space = self.tokenizer.get_vocab(), self.single(" ")
        self.starts = np.zeros(self.size, dtype=bool)
        if leading_space:
            self.starts[[i for token, i in vocabulary.items() if token.startswith(space)]] = True
        else:
            self.starts[self.tokenizer.encode(MARK, add_special_tokens=False).ids] = True
        # Tokens that end a run of letters, in a vocabulary that has marks for that.
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def joined(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def marked(self, texts: list[str], odd: bool) -> bytes:
        """All texts with a mark at every place where they may be cut, and ``END`` after each."""
        if self.leading_space and odd:
            texts = [BETWEEN.sub(f"{CUT} ", BREAK.sub(f"{CUT}\n{CUT}", text)) for text in texts]
        data = with_stops_cut((f"{CUT}{END}{CUT}".join(texts) + f"{CUT}{END}").encode())
        if not self.leading_space:
            # No token holds white space, and the vocabulary knows lower case alone.
            return data.translate(LOWER).replace(b"\n", b" ").replace(b" ", b"\0")
        return data if odd else data.replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0")

    def any_units(self, units: pa.Array) -> Found:
        """Ids of any units."""
        found = self.encoded([unit.decode() for unit in units.to_pylist()])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), dtype="<u4"), sizes

    def after_spaces(self, units: pa.Array) -> Found:
        """Ids of units that are a space and characters that are no white space."""
        ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
        for text, number in runs(units, b""):
            ids.append(self.joined(text))
            begins = np.flatnonzero(self.starts[ids[-1]])
            sizes.append(self.matching(np.diff(begins, append=len(ids[-1])), number))
        return np.concatenate(ids), np.concatenate(sizes)

    def of_letters(self, units: pa.Array) -> Found:
        """Ids of units whose last token, and no other, ends a run of letters."""
        ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
        for text, number in runs(units, b" "):
            ids.append(self.joined(text))
            stops = np.flatnonzero(self.ends[ids[-1]]) + 1
            sizes.append(self.matching(np.diff(stops, prepend=0), number))
        return np.concatenate(ids), np.concatenate(sizes)

    @staticmethod
    def matching(sizes: np.ndarray, number: int) -> np.ndarray:
        if len(sizes) != number:
            raise AssertionError("words and their tokens do not match")
        return sizes

    def usual_units(self, units: pa.Array) -> Found:
        """Ids of units of texts without unusual white space."""
        if self.leading_space:
            many, of_many = pc.starts_with(units, b" ").to_numpy(zero_copy_only=False), self.after_spaces
        else:
            many, of_many = letters_only(units), self.of_letters
        kinds = [(np.flatnonzero(many), of_many), (np.flatnonzero(~many), self.any_units)]
        found = [compute(units.take(pa.array(at))) for at, compute in kinds]
        sizes = np.empty(len(units), dtype=np.int64)
        ids = np.empty(sum(len(own) for own, _ in found), dtype="<u4")
        for (at, _), (_, own) in zip(kinds, found):
            sizes[at] = own
        starts = np.cumsum(sizes) - sizes
        for (at, _), (own, many) in zip(kinds, found):
            place = np.repeat(starts[at] - (np.cumsum(many) - many), many)
            ids[place + np.arange(len(place))] = own
        return ids, sizes

    def ids(self, texts: list[str], odd: bool) -> list[bytes]:
        """Ids of texts without marks of ours; ``odd``: with unusual white space."""
        data = pa.array([self.marked(texts, odd)], pa.large_binary())
        units = pc.split_pattern(data, CUT.encode()).flatten()
        rows = self.units.learn(units, self.any_units if odd else self.usual_units)
        ends = np.cumsum(self.units.sizes[rows])[rows == 0]
        together, bounds = self.units.gathered(rows).tobytes(), (4 * ends).tolist()
        return [together[a:b] for a, b in zip([0, *bounds], bounds)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        kinds: tuple[list[int], list[int], list[int]] = ([], [], [])
        for i, text in enumerate(texts):
            kinds[2 if CUT in text or END in text else int(self.leading_space and unusual(text))].append(i)
        for odd in (False, True):
            if kinds[odd]:
                for i, ids in zip(kinds[odd], self.ids([texts[i] for i in kinds[odd]], odd)):
                    out[i] = ids
        for i, ids in zip(kinds[2], self.encoded([texts[i] for i in kinds[2]])):
            out[i] = ids
        return out

    def single(self, text: str) -> str:
        tokens = self.tokenizer.encode(text, add_special_tokens=False).tokens
        return tokens[0] if tokens else ""

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of any texts; those that can be told apart are encoded together."""
        out: list[bytes] = [b""] * len(words)
        together, alone, letters = [], [], []
        for i, w in enumerate(words):
            if not self.leading_space and w.isalpha() and (w.isascii() or max(w) < "Ā"):
                letters.append(i)
                continue
            if self.leading_space:
                clear = w[:1] == " " and " " not in w[1:] and not (w[1:2].isspace() or w[-1].isspace())
            else:
                clear = MARK not in w
            (together if clear else alone).append(i)
        for start in range(0, len(alone), 4096):
            some = alone[start : start + 4096]
            done = self.tokenizer.encode_batch_fast([words[i] for i in some], add_special_tokens=False)
            for i, x in zip(some, done):
                out[i] = np.array(x.ids, dtype="<u4").tobytes()
        for start in range(0, len(letters), 16384):
            some = letters[start : start + 16384]
            ids = self.joined(" ".join([words[i] for i in some]))
            raw, stops = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) != len(some):
                raise AssertionError("words and their tokens do not match")
            for i, a, b in zip(some, [0, *stops], stops):
                out[i] = raw[a:b]
        between = "" if self.leading_space else f" {MARK} "
        for start in range(0, len(together), 16384):
            some = together[start : start + 16384]
            text = between.join([words[i] for i in some])
            text = text if self.leading_space else f"{MARK} {text}"
            ids = self.joined(text)
            begins = np.flatnonzero(self.starts[ids])
            if len(begins) != len(some):
                raise AssertionError("words and their tokens do not match")
            raw, ends = ids.tobytes(), (4 * np.append(begins[1:], len(ids))).tolist()
            begins = (4 * (begins + (not self.leading_space))).tolist()
            for i, a, b in zip(some, begins, ends):
                out[i] = raw[a:b]
        return out


@cache
def encoder(path: str, leading_space: bool) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, leading_space)
