"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of every new word.  A proposal is right if each
token is what merging makes of its own letters and every two neighbours are compatible,
that is, no merge across their border would have come first.  Compatibility of all
distinct neighbours is checked at once with array operations that undo merges from the
latest to the earliest.  Only words that fail are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import small_batches

#: Words a worker remembers at most before it starts anew.
REMEMBERED = 150_000
#: Longer words are merged one by one, shorter ones together.
LONG_WORD = 256
#: Rank of a pair that never merges.
NEVER = np.iinfo(np.int64).max
#: A longer text is cut at white space before it is split into words.
PIECE_CHARS = 1 << 20

# White space of the tokenizer's patterns, and its word pattern.
_SPACE = r"[\t-\r \x85\xa0  -     　]"
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+".replace(r"\s", _SPACE[1:-1])

#: The same for lower-case text of the first 256 code points, where it is faster.
_LATIN_WORD = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa00-9²³¹¼-¾a-zªµºß-öø-ÿ]+"
)


def _byte_letters() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges of a tokenizer file with word ends, and the words encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.word = regex.compile(_WORD)
        self.gap = regex.compile(_SPACE)
        letters = _byte_letters()
        self.letters = {b: x for b, x in letters.items() if x != chr(b)}
        self.first = np.array([self.ids[letters[b]] for b in range(256)])
        self.last = np.array([self.ids[letters[b] + self.end] for b in range(256)])
        self.longest = max(map(len, self.ids))
        self.children, self.child, self.accepts = self._trie(letters)
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = np.full(size, "", dtype=object)
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        #: Rank of the merge that makes a token, -1 for letters; its two parts.
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, merge in enumerate(model["merges"]):
            x, y = merge if isinstance(merge, list) else merge.split(" ")
            a, b, ab = self.ids[x], self.ids[y], self.ids[x + y]
            self.merges[a, b] = (r, ab)
            if self.rank[ab] < 0:
                self.rank[ab], self.left[ab], self.right[ab] = r, a, b
        pairs = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.pair_rank = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.pair_token = np.array([ab for _, ab in self.merges.values()], dtype=np.int64)[order]
        self.sound = np.zeros(size, dtype=np.int8)  # 1: merging its letters gives the token, -1: not
        self.forget()

    def forget(self) -> None:
        self.known = _Known()
        self.starts = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def _trie(self, letters: dict[int, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Steps (node * 512 + letter) and where they lead; the token that ends at each node.

        The last letter of a word counts 256 more than inside it.
        """
        byte = {x: b for b, x in letters.items()}
        steps, accepts = {}, [-1]
        for token, i in self.ids.items():
            body = token.removesuffix(self.end)
            path = [byte[x] for x in body]
            if body != token and path:
                path[-1] += 256
            node = 0
            for letter in path:
                key = node << 9 | letter
                node = steps.get(key, 0)
                if not node:
                    node = steps[key] = len(accepts)
                    accepts.append(-1)
            if node:
                accepts[node] = i
        keys = np.fromiter(steps.keys(), dtype=np.int64, count=len(steps))
        order = np.argsort(keys)
        return keys[order], np.fromiter(steps.values(), dtype=np.int64, count=len(steps))[order], np.array(accepts)

    def propose(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match in many words at once: word and token, in order."""
        marked = letters.astype(np.int64)
        marked[ends - 1] += 256
        word, at, end = np.arange(len(starts)), starts.copy(), ends
        pos, node = at.copy(), np.zeros(len(at), dtype=np.int64)
        token, stop = np.full(len(at), -1), at.copy()
        found_word, found_at, found_token = [], [], []
        while len(word):
            key = node << 9 | marked[pos]
            i = np.minimum(np.searchsorted(self.children, key), len(self.children) - 1)
            on = self.children[i] == key
            node = np.where(on, self.child[i], 0)
            pos = pos + on
            ok = on & (self.accepts[node] >= 0)
            token, stop = np.where(ok, self.accepts[node], token), np.where(ok, pos, stop)
            out = ~on | (pos == end)
            if out.any():
                found_word.append(word[out])
                found_at.append(at[out])
                found_token.append(token[out])
                at, pos = np.where(out, stop, at), np.where(out, stop, pos)
                node, token = np.where(out, 0, node), np.where(out, -1, token)
                left = at < end
                if not left.all():
                    word, at, end, pos, node, token, stop = (x[left] for x in (word, at, end, pos, node, token, stop))
        order = np.argsort(np.concatenate(found_at))
        return np.concatenate(found_word)[order], np.concatenate(found_token)[order]

    def propose_one(self, word: bytes) -> list[int]:
        """Greedy longest match in one long word."""
        text = word.decode("latin-1").translate(self.letters)
        at, out, find, end, n = 0, [], self.ids.get, self.end, len(text)
        while at < n:
            for to in range(min(n, at + self.longest), at, -1):
                token = find(text[at:to] + end if to == n else text[at:to])
                if token is not None:
                    out.append(token)
                    break
            at = to
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether no merge across the border of two tokens comes before theirs."""
        good = np.ones(len(left), dtype=bool)
        at, l, r = np.arange(len(left)), left.astype(np.int64), right.astype(np.int64)
        before = np.full(len(left), NEVER)
        while len(at):
            rank, _ = self.lookup(l, r)
            crossed = rank < before
            good[at[crossed]] = False
            on = ~crossed & ((self.rank[l] >= 0) | (self.rank[r] >= 0))
            at, l, r = at[on], l[on], r[on]
            # The later merge is undone; of equal ones the right, which came second.  A merge
            # of its rank one place further left would have come first.
            later_left = self.rank[l] > self.rank[r]
            before = np.where(later_left, self.rank[l], self.rank[r] + 1)
            l, r = np.where(later_left, self.right[l], l), np.where(later_left, r, self.left[r])
        return good

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair of tokens."""
        key = left << 32 | right
        i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = self.pairs[i] == key
        return np.where(found, self.pair_rank[i], NEVER), self.pair_token[i]

    def merge_all(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once, in each the leftmost pair of lowest rank."""
        flat = self.first[letters]
        flat[ends - 1] = self.last[letters[ends - 1]]
        sizes = ends - starts
        owner = np.repeat(np.arange(len(starts)), sizes)
        flat = flat[np.arange(len(owner)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)]
        done = []
        while len(flat):
            border = owner[1:] != owner[:-1]
            rank, merged = np.full(len(flat), NEVER), np.zeros(len(flat), dtype=np.int64)
            rank[:-1], merged[:-1] = self.lookup(flat[:-1], flat[1:])
            rank[:-1][border] = NEVER
            begins = np.flatnonzero(np.r_[True, border])
            best = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.r_[begins, len(flat)]))
            on = best < NEVER
            done.append((owner[~on], flat[~on]))
            hits = np.flatnonzero(on & (rank == best))
            if len(hits):
                hits = hits[np.r_[True, owner[hits][1:] != owner[hits][:-1]]]
            flat[hits] = merged[hits]
            on[hits + 1] = False
            flat, owner = flat[on], owner[on]
        owner, flat = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return owner[order], flat[order]

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word with a heap."""
        symbols = self.first[np.frombuffer(word, dtype=np.uint8)].tolist()
        symbols[-1] = int(self.last[word[-1]])
        n = len(symbols)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < n and (found := self.merges.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                prior[after[j]] = i
            offer(prior[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    def _token_sound(self, token: int) -> bool:
        todo, letters = [token], []
        while todo:
            t = todo.pop()
            if self.rank[t] < 0:
                letters.append(t)
            else:
                todo += [int(self.right[t]), int(self.left[t])]
        text = "".join(self.tokens[t] for t in letters)
        return text == self.tokens[token] and self._merge_ids(letters) == [token]

    def _merge_ids(self, symbols: list[int]) -> list[int]:
        """Exact merging of the few letters of one token."""
        symbols = list(symbols)
        while len(symbols) > 1:
            found = [(self.merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in self.merges]
            if not found:
                break
            i = min(found)[1]
            symbols[i : i + 2] = [self.merges[symbols[i], symbols[i + 1]][1]]
        return symbols

    def learn(self) -> None:
        """Encode the words met since the last call."""
        words = self.known.new
        if not words:
            return
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        letters = np.frombuffer(b"".join(data), dtype=np.uint8)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        short = np.flatnonzero(sizes <= LONG_WORD)
        owner, flat = self.propose(letters, starts[short], ends[short]) if len(short) else (short, short)
        owner = short[owner]
        long = np.flatnonzero(sizes > LONG_WORD).tolist()
        owner, flat = _together([(owner, flat), *(([i] * len(p), p) for i in long if (p := self.propose_one(data[i])))])
        for t in np.unique(flat):
            if not self.sound[t]:
                self.sound[t] = 1 if self._token_sound(int(t)) else -1
        wrong = np.zeros(len(words), dtype=bool)
        wrong[owner[self.sound[flat] < 0]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, where = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        fits = self.compatible(keys >> 32, keys & 0xFFFFFFFF)
        wrong[owner[inner[~fits[where]]]] = True
        if wrong.any():
            good = ~wrong[owner]
            again = short[wrong[short]]
            fixed = self.merge_all(letters, starts[again], ends[again]) if len(again) else (again, again)
            exact = [([i] * len(p), p) for i in long if wrong[i] and (p := self.merge(data[i]))]
            owner, flat = _together([(owner[good], flat[good]), (again[fixed[0]], fixed[1]), *exact])
        lengths = np.bincount(owner, minlength=len(words))
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.known.new = []

    def words(self, text: str) -> Iterator[list[str]]:
        at = 0
        while at < len(text):
            to = at + PIECE_CHARS
            if to < len(text):
                space = self.gap.search(text, to)
                to = space.start() if space else len(text)
            piece = unicodedata.normalize("NFC", text[at:to]).replace("Σ", "σ").lower()
            try:
                piece.encode("latin-1")
            except UnicodeEncodeError:
                yield self.word.findall(piece)
            else:
                yield _LATIN_WORD.findall(piece)
            at = to

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """Numbers of the words of a text in turn; -1 - id stands for a special token."""
        marks = [(m.start(), m.end(), self.special[m.group()]) for m in self.cut.finditer(text)] if self.cut and "<|" in text else []
        at, number = 0, self.known.__getitem__
        for start, end, special in [*marks, (len(text), len(text), None)]:
            for words in self.words(text[at:start]):
                yield np.fromiter(map(number, words), dtype=np.int64, count=len(words))
            if special is not None:
                yield np.array([-1 - special], dtype=np.int64)
            at = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts one after another, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self.forget()
        parts, owners = [], []
        for i, text in enumerate(texts):
            for part in self.parts(text):
                parts.append(part)
                owners.append((i, len(part)))
        counts = np.zeros(len(texts), dtype=np.int64)
        if not parts:
            return np.zeros(0, dtype=np.int32), counts
        self.learn()
        index = np.concatenate(parts)
        word = np.maximum(index, 0)
        if not len(self.flat):  # special tokens only
            lengths, begin = np.ones(len(index), dtype=np.int64), np.zeros(len(index), dtype=np.int64)
            out = np.zeros(len(index), dtype=np.int32)
            ends = np.cumsum(lengths)
        else:
            begin = self.starts[word]
            lengths = np.where(index < 0, 1, self.starts[word + 1] - begin)
            ends = np.cumsum(lengths)
            out = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + lengths, lengths)]
        out[(ends - 1)[index < 0]] = -1 - index[index < 0]
        np.add.at(counts, np.repeat([i for i, _ in owners], [n for _, n in owners]), lengths)
        return out, counts


def _together(parts) -> tuple[np.ndarray, np.ndarray]:
    """Word and token arrays, ordered by word."""
    owner = np.concatenate([np.asarray(o, dtype=np.int64) for o, _ in parts])
    flat = np.concatenate([np.asarray(f, dtype=np.int64) for _, f in parts])
    order = np.argsort(owner, kind="stable")
    return owner[order], flat[order]


class _Known(dict):
    """Numbers words as they come and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker."""
    return Vocabulary(path)


def encoder(path: str):
    """A column function from text to token ids; null and empty texts have none."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        vocab, values, counts = vocabulary(path), [], [np.zeros(1, dtype=np.int64)]
        for some in _portions(texts):
            ids, lengths = vocab.encode(some)
            values.append(ids)
            counts.append(lengths)
        offsets = np.cumsum(np.concatenate(counts)).astype(np.int32)
        flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))

    return encode


def _portions(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of about PIECE_CHARS characters."""
    some, chars = [], 0
    for text in texts:
        some.append(text.as_py() or "")
        chars += len(some[-1])
        if chars >= PIECE_CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


def decoder(path: str):
    """A column function from token ids to text: the tokens, joined by one space.

    This is what the tokenizer file, which names no decoder, asks for.  No ids: empty.
    """

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        tokens = vocabulary(path).tokens
        return pa.array([" ".join(tokens[np.asarray(x.values)].tolist()) if x.is_valid else "" for x in ids], type=pa.string())

    return decode


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of a text column (a column of that name is replaced)."""
    small_batches(df.sparkSession, 4)
    return df.withColumn(ids, encoder(path)(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of a column of token ids."""
    small_batches(df.sparkSession, 4)
    return df.withColumn(text, decoder(path)(F.col(ids)))


def joined(ids: Column) -> Column:
    """Decimal ids with one space between them."""
    return F.array_join(ids.cast("array<string>"), " ")
