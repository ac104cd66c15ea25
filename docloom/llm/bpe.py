"""Byte-pair encoding by speculation, and decoding.

Greedy longest match proposes the tokens of a word. Vectorised checks then test every adjacent
pair: two neighbours are compatible if merging by rank could not have joined symbols across their
border before both were complete. A word whose pairs all pass has the tokens that merging would
give; only the others are merged exactly. Words are handled once per task and kept in a bounded
table, so the cost follows the distinct words.

The vocabulary file names merges by rank, a suffix for the last symbol of a word, and special
tokens, which are cut out of the raw text first. Text is composed, lowered and split into runs of
letters, single digits, contractions and runs of other signs.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import small_batches
from docloom.llm.words import pieces

ENDING = "</w>"
# Words kept by a task before its table starts anew.
TABLE_WORDS = 120_000
# Above every rank.
NEVER = np.iinfo(np.int64).max
# Letters and digits among the code points below 256, and the white space there.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0"
_PIECE = (
    f"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^{_LETTERS}{_DIGITS}{_SPACE}]+"
)


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself, or one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in signs:
            signs[b] = chr(extra)
            extra += 1
    return [signs[b] for b in range(256)]


class Vocabulary:
    """Tables of one vocabulary file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        size = 1 + max(*self.ids.values(), *self.special.values())
        self.names = [""] * size
        for name, i in (self.ids | self.special).items():
            self.names[i] = name
        # By id: the rank that made a token, and its two parts (itself if it is a symbol).
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        keys = np.empty(len(merges), np.int64)
        made = np.empty(len(merges), np.int64)
        self.product = np.empty(len(merges), np.int64)
        twice: set[str] = set()
        for r, (a, b) in enumerate(merges):
            i, j, k = self.ids[a], self.ids[b], self.ids[a + b]
            keys[r], made[r], self.product[r] = (i << 32) | j, r, k
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = r, i, j
            else:
                twice.add(a + b)
        order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[order], made[order]
        self.signs = _byte_signs()
        self.spec = text
        self.plain = {n: i for n, i in self.ids.items() if not n.endswith(ENDING)}
        self.final = {n.removesuffix(ENDING): i for n, i in self.ids.items() if n.endswith(ENDING)}
        self.longest = max(map(len, [*self.plain, *self.final]))
        # A token that merging its own symbols does not give, or that two merges make, is never
        # proposed.
        names = [n for n in self.ids if len(n.removesuffix(ENDING)) > 1]
        whole = [self._symbols(n.removesuffix(ENDING), n.endswith(ENDING)) for n in names]
        tokens, sizes = self.merged(whole)
        first = np.cumsum(sizes) - sizes
        for n, at, size in zip(names, first.tolist(), sizes.tolist()):
            if n in twice or size != 1 or tokens[at] != self.ids[n]:
                (self.final if n.endswith(ENDING) else self.plain).pop(n.removesuffix(ENDING), None)
        # Proposals read on while a token begins so; a prefix that is no token leads to -1.
        self.prefixes: dict[str, int] = {}
        for n, i in self.plain.items():
            for end in range(1, len(n)):
                self.prefixes.setdefault(n[:end], -1)
            self.prefixes[n] = i

    @classmethod
    def of(cls, tables: dict) -> Vocabulary:
        """The vocabulary with these attributes, as sent to the tasks."""
        made = cls.__new__(cls)
        made.__dict__.update(tables)
        return made

    def _symbols(self, word: str, last: bool = True) -> list[int]:
        """Ids of the symbols that merging starts with."""
        ids = self.ids
        found = [ids[c] for c in word]
        if last:
            found[-1] = ids[word[-1] + ENDING]
        return found

    def _ranks(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NEVER where there is none."""
        key = (one << 32) | two
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NEVER)

    def merged(self, words: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of words given as symbols: all tokens in order, and how many per word.

        All words take one step at a time: the leftmost pair of the lowest rank is joined.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tokens = np.fromiter(chain.from_iterable(words), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        ranks = np.full(len(tokens), NEVER)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inner] = self._ranks(tokens[inner], tokens[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(tokens):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lengths = np.diff(np.append(starts, len(owner)))
            best = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            over = best == NEVER
            if over.any():
                done.append((owner[over], tokens[over]))
                go = ~over
                tokens, owner, ranks, best = tokens[go], owner[go], ranks[go], best[go]
                if not len(tokens):
                    break
            at = np.flatnonzero(ranks == best)
            at = at[np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))]
            tokens[at] = self.product[ranks[at]]
            stay = np.ones(len(tokens), np.bool_)
            stay[at + 1] = False
            ranks[at] = ranks[at + 1]
            at -= np.arange(len(at))
            tokens, owner, ranks = tokens[stay], owner[stay], ranks[stay]
            # Only the pairs on both sides of a joined token have changed.
            for near in (at[(at > 0)] - 1, at[at + 1 < len(tokens)]):
                same = near[owner[near] == owner[near + 1]]
                ranks[same] = self._ranks(tokens[same], tokens[same + 1])
        if not done:
            return tokens, sizes
        owner, tokens = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(owner, kind="stable")
        return tokens[order], np.bincount(owner, minlength=len(words))

    def proposed(self, word: str) -> list[int]:
        """Tokens of a word by greedy longest match."""
        prefixes, final, longest = self.prefixes, self.final, self.longest
        found, at, size = [], 0, len(word)
        while True:
            if size - at <= longest and (i := final.get(word[at:])) is not None:
                found.append(i)
                return found
            end = at
            for place in range(at + 1, size):
                i = prefixes.get(word[at:place])
                if i is None:
                    break
                if i >= 0:
                    token, end = i, place
            found.append(token)
            at = end

    def compatible(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbours survives merging.

        The merges that made the two tokens are undone from the latest; at each step the symbols
        at the border must not have a merge that comes before the step that follows.
        """
        size, rank = len(one), self.rank
        good, alive = np.ones(size, np.bool_), np.arange(size)
        a, b = one.astype(np.int64), two.astype(np.int64)
        limit = np.full(size, NEVER)
        while len(alive):
            bad = self._ranks(a, b) < limit
            good[alive[bad]] = False
            # Undo the later of the two merges; a tie is one token twice, its left copy first.
            ra, rb = rank[a], rank[b]
            first = ra > rb
            # At equal rank the left one was made first, so the right one is undone first: its
            # border merge must come strictly before the left token was complete.
            limit = np.where(first, ra, rb + 1)
            done = np.maximum(ra, rb) < 0
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
            go = ~bad & ~done
            alive, a, b, limit = alive[go], a[go], b[go], limit[go]
        return good


class Encoder:
    """Words of a task with their tokens, as one flat array, and their decoded form."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.piece = re.compile(_PIECE)
        self.cut = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.library = None
        self._clear()

    def _clear(self):
        self.index: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 19, np.uint32), 0
        self.start, self.count = np.zeros(1 << 17, np.int64), np.zeros(1 << 17, np.int64)

    def _words(self, text: str) -> list[str]:
        """Pieces of a normalized text; a special token is a piece of its own."""
        if self.cut is not None and "<" in text:
            parts = self.cut.split(text)
            if len(parts) > 1:
                found = []
                for i, part in enumerate(parts):
                    found += [part] if i % 2 else self._words(part)
                return found
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._rare(text)
        return self.piece.findall(text.lower())

    def _rare(self, text: str) -> list[str]:
        """Pieces of a text beyond the first 256 code points, by the library's own splitter."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.vocabulary.spec)
            self.back = {s: b for b, s in enumerate(self.vocabulary.signs)}
        normal = self.library.normalizer.normalize_str(text)
        signs = (p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal))
        return [bytes(self.back[c] for c in p).decode() for p in signs]

    def _add(self, words: list[str]) -> None:
        """Tokens of words that are not in the table yet, which get the next indices."""
        vocabulary, sign = self.vocabulary, self.vocabulary.signs.__getitem__
        shown, found = [], []
        for word in words:
            special = vocabulary.special.get(word)
            shown.append("".join(map(sign, word.encode())))
            found.append([special] if special is not None else vocabulary.proposed(shown[-1]))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        tokens = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique((tokens[inner] << 32) | tokens[inner + 1], return_inverse=True)
        good = vocabulary.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]
        failed = np.unique(owner[inner[~good]])
        if len(failed):
            exact, lengths = vocabulary.merged([vocabulary._symbols(shown[i]) for i in failed])
            stay = ~np.isin(owner, failed)
            owner = np.concatenate((owner[stay], np.repeat(failed, lengths)))
            tokens = np.concatenate((tokens[stay], exact))[np.argsort(owner, kind="stable")]
            sizes = np.bincount(owner, minlength=len(words))
        have, total = len(self.index) - len(words), len(tokens)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while have + len(words) > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
            self.count = np.concatenate((self.count, np.zeros_like(self.count)))
        self.flat[self.used : self.used + total] = tokens
        self.start[have : have + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.count[have : have + len(words)] = sizes
        self.used += total

    def encode(self, texts) -> list[np.ndarray]:
        """Token ids of each text; a null text has none."""
        if len(self.index) > TABLE_WORDS:
            self._clear()
        index, fresh, lines = self.index, [], []
        for text in texts:
            found = self._words(text) if text else []
            new = {w for w in found if w not in index} if found else ()
            for w in new:
                index[w] = len(index)
                fresh.append(w)
            lines.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
        if fresh:
            self._add(fresh)
        out = []
        for words in lines:
            sizes = self.count[words]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            place = np.repeat(self.start[words] - ends + sizes, sizes) + np.arange(total)
            out.append(self.flat[place])
        return out


def _vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers.

    ``path`` names the vocabulary file, read on the driver; its tables have a fixed, small size. A
    null text has no tokens. Other columns pass through; a column called like ``ids`` is replaced.
    """
    small_batches(docs.sparkSession)
    tables = docs.sparkSession.sparkContext.broadcast(vars(_vocabulary(path)))
    kept = docs.drop(ids)

    def run(batches):
        encoder = Encoder(Vocabulary.of(tables.value))
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for begin, end in pieces(texts, 1 << 20):
                found = [f.astype("<u4").tobytes() for f in encoder.encode(texts[begin:end])]
                part = batch.slice(begin, end - begin)
                yield part.append_column(ids, pa.array(found, pa.binary()))

    return kept.mapInArrow(run, kept.withColumn(ids, F.lit(b"")).schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids: the names of the tokens, one space between them.

    The vocabulary states no decoder, so special tokens and word endings stay as they are. Null
    ids are no tokens. Other columns pass through; a column called like ``text`` is replaced.
    """
    small_batches(encoded.sparkSession)
    tables = encoded.sparkSession.sparkContext.broadcast(_vocabulary(path).names)
    kept = encoded.drop(text)

    def run(batches):
        name = tables.value.__getitem__
        for batch in batches:
            raw = batch.column(ids).to_pylist()
            for begin, end in pieces(raw, 2 << 20):
                lists = (np.frombuffer(r or b"", "<u4").tolist() for r in raw[begin:end])
                found = [" ".join(map(name, i)) for i in lists]
                part = batch.slice(begin, end - begin)
                yield part.append_column(text, pa.array(found, pa.string()))

    return kept.mapInArrow(run, kept.withColumn(text, F.lit("")).schema)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` without ``text``, with its ``ids`` and the text ``decoded`` from them.

    The same as ``encode`` and ``decode`` one after the other, in one Python worker per task.
    """
    small_batches(docs.sparkSession)
    tables = docs.sparkSession.sparkContext.broadcast(vars(_vocabulary(path)))
    kept = docs.drop(ids, decoded)

    def run(batches):
        vocabulary = Vocabulary.of(tables.value)
        encoder, name = Encoder(vocabulary), vocabulary.names.__getitem__
        for batch in batches:
            texts, rest = batch.column(text).to_pylist(), batch.drop_columns([text])
            for begin, end in pieces(texts, 1 << 20):
                found = encoder.encode(texts[begin:end])
                raw = pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())
                back = pa.array([" ".join(map(name, f.tolist())) for f in found], pa.string())
                part = rest.slice(begin, end - begin)
                yield part.append_column(ids, raw).append_column(decoded, back)

    schema = kept.drop(text).withColumn(ids, F.lit(b"")).withColumn(decoded, F.lit("")).schema
    return kept.mapInArrow(run, schema)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """``keep``, number of tokens, and digests of the ids and of the decoded text."""
    rows = docs.select(*keep, F.col("text"))
    return round_trip(rows, path).select(
        *keep,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def bpe_query(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, default_path(), "doc_id")
