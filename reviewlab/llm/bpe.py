"""Byte-pair encoding and decoding without replaying merges.

Every prefix of a word has one valid last token. The tokens that end at a position are
the automaton's matches there; the one to keep is the one that may follow the last token
of the prefix it leaves, which a test of the two tokens alone decides. Following the stored
tokens back from the end of the word gives the ids. Time is linear in the word's length.

Edge cases: a null text counts as empty and gives no ids; repeated rows are each encoded;
other columns are ignored, so their names cannot clash; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame, types as T
from tokenizers import Tokenizer

from reviewlab.llm.common import fields, map_rows, short_batches

#: Chunks between white space whose ids a worker remembers, in each of two generations.
CACHE_CHUNKS = 300_000
#: Words whose ids a worker remembers, likewise: chunks with the same word and other
#: punctuation share it.
CACHE_WORDS = 100_000
#: Token pairs whose compatibility a worker remembers before it starts afresh.
CACHE_PAIRS = 500_000
#: Stands for the end of a word inside the automaton; no byte is written this way.
END = ""
NEVER = 1 << 60
#: White space as Unicode defines it (``str.split`` also splits at four control characters).
CHUNK = re.compile(
    "[^\t-\r \x85\xa0  -     　]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(moved)) for b in range(256)]


class Remembered(dict):
    """Ids by chunk or word: a full generation becomes the old one, and what was in the old one
    and not asked for since is forgotten."""

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most = encode, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.encode(text)
            if len(text) > 64:
                return ids
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[text] = ids
        return ids


class WordVocabulary:
    """A vocabulary whose words end in a marked symbol, with its pair test and automaton."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.text = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text |= {i: t for t, i in self.special.items()}
        self.byte = byte_symbols()
        self.fold = str.maketrans({chr(b): s for b, s in enumerate(self.byte)})

        vocab = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        born, parts = {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.rank[pair] = rank
            if made in parts:
                raise ValueError(f"merge {rank} makes a token that another one makes")
            born[made], parts[made] = rank, pair
        for made, pair in parts.items():
            if max(born.get(p, -1) for p in pair) > born[made]:
                raise ValueError(f"merge {born[made]} comes before the merges of its parts")

        #: Pieces at a token's right and left edge, each with the rank that ends its life.
        self.tails = {t: self._edge(t, parts, born, 1) for t in vocab.values()}
        self.heads = {t: self._edge(t, parts, born, 0) for t in vocab.values()}

        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            word = token[: -len(suffix)] + END if token.endswith(suffix) else token
            base = i not in parts
            if base and len(word.rstrip(END)) != 1:
                continue  # neither a symbol nor merged: no text can produce it
            if not base and not self._follows(*parts[i], until=born[i]):
                continue  # its own text is merged differently
            self.automaton.add_word(word, (len(word), i))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.symbol_words = Remembered(self._word_ids, CACHE_WORDS)
        self.ascii_words = Remembered(lambda w: self._word_ids(w.translate(self.fold)), CACHE_WORDS)

        escaped = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(escaped) + ")") if escaped else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"])
        #: Letters and digits beyond ASCII are what the library's own Unicode tables say.
        library = Tokenizer.from_str(file)
        self.normalize = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str

    @staticmethod
    def _edge(token: int, parts: dict, born: dict, side: int) -> list[tuple[int, int]]:
        pieces, dies = [(token, NEVER)], NEVER
        while token in parts:
            dies, token = born[token], parts[token][side]
            pieces.append((token, dies))
        return pieces

    def _follows(self, left: int, right: int, until: int = NEVER) -> bool:
        """No merge before ``until`` joins the end of ``left`` to the start of ``right``.

        A piece takes part in merges of a rank below the one that ends its life; of two
        merges of one rank the left one comes first.
        """
        rank = self.rank
        for a, a_dies in self.tails[left]:
            for b, b_dies in self.heads[right]:
                r = rank.get((a, b))
                if r is not None and r < until and r < a_dies and r <= b_dies:
                    return False
        return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word written in byte symbols."""
        text = word + END
        last: list[tuple[int, int] | None] = [None] * (len(text) + 1)
        pairs = self.pairs
        for end, match in self.automaton.iter(text):
            if last[end + 1] is None:
                start = end + 1 - match[0]
                if start:
                    before = last[start]
                    if before is None:
                        continue
                    key = before[1] << 32 | match[1]
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= CACHE_PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self._follows(before[1], match[1])
                    if not fits:
                        continue
                last[end + 1] = match
        ids, at = [], len(text)
        while at:
            length, token = last[at]
            ids.append(token)
            at -= length
        ids.reverse()
        return ids

    def _word_ids(self, word: str) -> bytes:
        return array("I", self.encode_word(word)).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a text without white space."""
        ids: list[bytes] = []
        for part in self.specials.split(chunk) if self.specials else [chunk]:
            if part in self.special:
                ids.append(array("I", [self.special[part]]).tobytes())
            elif part.isascii():
                ids += map(self.ascii_words.__getitem__, self.words.findall(part.lower()))
            else:
                found = self.pre_tokenize(self.normalize(part))
                ids += [self.symbol_words[word] for word, _ in found]
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """Token strings joined by spaces: what a vocabulary without a decoder prints."""
        return " ".join(map(self.text.__getitem__, array("I", ids)))


@lru_cache(maxsize=2)
def load(path: str) -> WordVocabulary:
    """The vocabulary in a tokenizer file, once per process."""
    with open(path, encoding="utf-8") as f:
        return WordVocabulary(f.read())


@lru_cache(maxsize=2)
def remembered(path: str) -> Remembered:
    return Remembered(load(path).encode_chunk, CACHE_CHUNKS)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the ids of each whole text as little-endian 32-bit integers."""
    return _run(df, path, id_col, text_col, with_text=False)


def round_trip(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, ids, decoded)``: the ids, and the text decoded from them, in one pass."""
    return _run(df, path, id_col, text_col, with_text=True)


def _run(df: DataFrame, path: str, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    short_batches(df.sparkSession)
    out = [T.StructField("ids", T.BinaryType())]
    if with_text:
        out.append(T.StructField("decoded", T.StringType()))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        vocabulary, chunks = load(path), remembered(path)
        for columns in batches:
            ids = [
                b"".join(map(chunks.__getitem__, CHUNK.findall(text or "")))
                for text in columns[text_col].to_pylist()
            ]
            done = {id_col: columns[id_col], "ids": ids}
            if with_text:
                done["decoded"] = list(map(vocabulary.decode, ids))
            yield done

    return map_rows(
        df.select(id_col, text_col), work, T.StructType([*fields(df, id_col), *out])
    )


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, decoded)`` of ids as ``encode`` writes them; null counts as none."""
    short_batches(df.sparkSession)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        vocabulary = load(path)
        for columns in batches:
            texts = [vocabulary.decode(ids or b"") for ids in columns[ids_col].to_pylist()]
            yield {id_col: columns[id_col], "decoded": texts}

    schema = T.StructType([*fields(df, id_col), T.StructField("decoded", T.StringType())])
    return map_rows(df.select(id_col, ids_col), work, schema)
