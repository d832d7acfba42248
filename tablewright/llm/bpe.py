"""BPE encoding by a token automaton that is compiled merge by merge (operator 9).

A state of the automaton says which tokens may follow. It starts as one state in which any base
symbol may follow any other. The gadget of a merge ``(u, v) -> w`` at time ``k`` takes the state
reached by ``u``, copies it without the arc ``v`` and leads all arcs ``u`` to the copy; next to
every arc ``u`` whose copy lost ``v`` it lays an arc ``w`` to the state that ``v`` led to. Where no
``v`` followed ``u`` any more, the gadget changes nothing. So each token leads to one state, each
copy differs from its original by one arc, and the automaton needs one entry per merge:
``cut[(u, v)] = k``. Whether an arc is there follows from these entries (``_arc``); answers are
kept in the transition table. One path through the automaton spells a word, and it is the word's
encoding. Each beginning of a word has one such path too, so one arc ends at each symbol. The encoder
therefore walks a word once, one step a symbol, and never steps back. A state of this walk (``_State``) is the
longest beginning of a label that the symbols read end with (``_Node``) and, for each of its places, the
arc that ends there; the next symbol leads to one state, which is worked out when first met and kept in
a table. From the last symbol back, the arcs spell the encoding.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import getitem

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from .common import column, read_file, send, slices, text_of

KEPT_WORDS = 250_000  # encoded words a worker keeps; the oldest half goes when it is full
KEPT_ARCS = 2_000_000  # transitions a worker keeps
KEPT_STEPS = 500_000  # steps of the walk a worker keeps, with the states they lead to; others are worked out each time
LATIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")  # printable ASCII and the letters of Latin-1 that have case
END = "\0"  # stands for the word-end suffix inside this module, so that it is one character


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    shifted = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + shifted.index(b)) for b in range(256)]


class _Node(dict):
    """A beginning of a label: symbol -> the beginning that is longer by it."""

    __slots__ = ("ends", "number", "rest", "size")

    def __init__(self, number: int, size: int):
        self.number, self.size = number, size
        self.rest: _Node | None = None  # the longest other beginning that this one ends with
        self.ends: tuple[tuple[int, int], ...] = ()  # the tokens that end here with their lengths, longest first

    def after(self, symbol: str) -> _Node:
        """The longest beginning that ends with this symbol."""
        node = self
        while symbol not in node:
            if node.rest is None:
                raise ValueError(f"the symbol {symbol!r} is not in the vocabulary")
            node = node.rest
        return node[symbol]


class _State(dict):
    """What is known after some symbols of a word: symbol -> the next state, filled in as met."""

    __slots__ = ("end", "kept", "node", "step")

    def __init__(self, node: _Node, kept: tuple[int, ...], end: tuple[int, int], step: Callable[[_State, str], _State]):
        self.node, self.kept, self.step = node, kept, step
        self.end = end  # the token of the arc that ends here, and its length

    def __missing__(self, symbol: str) -> _State:
        return self.step(self, symbol)


class MergeAutomaton:
    """The automaton of a merge list. ``vocab``: label -> id; labels of word ends carry ``suffix``."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        own = (lambda s: s[: -len(suffix)] + END if s.endswith(suffix) and s != suffix else s) if suffix else (lambda s: s)
        self.ids = {own(label): i for label, i in vocab.items()}
        self.made: dict[int, tuple[int, int, int]] = {}
        self.cut: dict[tuple[int, int], int] = {}
        self.arcs: dict[int, bool] = {}
        base = {i for label, i in self.ids.items() if len(label.removesuffix(END)) == 1}
        for k, (left, right) in enumerate(merges, start=1):
            u, v, w = self.ids[own(left)], self.ids[own(right)], self.ids[own(left + right)]
            for part in (u, v):
                if part not in base and part not in self.made:
                    raise ValueError(f"merge {k} uses a token that no earlier merge makes")
            if self._arc(u, v, k - 1):
                if w in self.made:
                    raise ValueError(f"merge {k} makes a token for the second time")
                self.made[w] = (u, v, k)
                self.cut[(u, v)] = k
        live = base | self.made.keys()
        root = self._beginnings({label: i for label, i in self.ids.items() if i in live})
        self.start = _State(root, (-1,), (-1, 0), self._step)
        self.states: dict[tuple[int, tuple[int, ...]], _State] = {}
        self.room = KEPT_STEPS

    def _symbols(self, label: str) -> list[str]:
        """The last symbol and the suffix are one symbol."""
        return [*label[:-2], label[-2:]] if self.suffix and label.endswith(END) else list(label)

    def _beginnings(self, labels: dict[str, int]) -> _Node:
        root, number = _Node(0, 0), 0
        for label, token in labels.items():
            node, symbols = root, self._symbols(label)
            for symbol in symbols:
                if symbol not in node:
                    number += 1
                    node[symbol] = _Node(number, node.size + 1)
                node = node[symbol]
            node.ends = ((token, len(symbols)),)
        level = [root]
        while level:  # shorter beginnings first
            below = []
            for node in level:
                for symbol, child in node.items():
                    child.rest = root if node is root else node.rest.after(symbol) if symbol in root else root
                    child.ends += child.rest.ends
                    below.append(child)
            level = below
        return root

    def _step(self, state: _State, symbol: str) -> _State:
        node, kept, arcs = state.node.after(symbol), state.kept, self.arcs.get
        for end in node.ends:
            token, length = end
            before = kept[-length]
            if before < 0:
                break
            allowed = arcs(before << 32 | token)
            if self.follows(before, token) if allowed is None else allowed:
                break
        else:
            raise ValueError(f"no path reads {symbol!r} here")
        kept = (*kept, token)[-node.size - 1 :]
        following = self.states.get((node.number, kept))
        if following is None:
            following = _State(node, kept, end, state.step)
        if self.room > 0:
            self.room -= 1
            self.states[node.number, kept] = state[symbol] = following
        return following

    def _removed(self, u: int, t: int, time: int) -> bool:
        """Has the state of ``u`` lost its arc ``t`` by this time? A new token starts with the state of its right part."""
        while True:
            if self.cut.get((u, t), time + 1) <= time:
                return True
            if u not in self.made:
                return False
            _, u, k = self.made[u]
            time = min(time, k - 1)

    def _arc(self, u: int, t: int, time: int) -> bool:
        """May ``t`` follow ``u``? An arc ``w`` was laid only where its left part could follow at that time."""
        while not self._removed(u, t, time):
            if t not in self.made:
                return True
            t, _, k = self.made[t]
            time = min(time, k)
        return False

    def follows(self, u: int, t: int) -> bool:
        key = u << 32 | t
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._arc(u, t, len(self.cut) + len(self.ids) + 1 << 8)
        return known

    def encode(self, word: str) -> list[int]:
        """The ids of one word, given as byte symbols without suffix."""
        symbols = [*word[:-1], word[-1:] + END] if self.suffix and word else word
        ends = [state.end for state in accumulate(symbols, getitem, initial=self.start)]
        path: list[int] = []
        at = len(ends) - 1
        while at:
            token, length = ends[at]
            path.append(token)
            at -= length
        path.reverse()
        return path


class Tokenizer:
    """Normalise, split into words, encode and decode as a tokenizer file says.

    Understood: normalisers NFC, white space to one space, lower case; splitting by a pattern whose
    matches are the words, then byte level; BPE without dropout or byte fallback; special tokens
    without stripping; no decoder. Other files are refused.
    """

    def __init__(self, content: bytes):
        file = json.loads(content)
        model = file["model"]
        steps = {s["type"] for s in (file["normalizer"] or {}).get("normalizers", [])}
        split, level = file["pre_tokenizer"]["pretokenizers"]
        plain = not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        shaped = steps == {"NFC", "Replace", "Lowercase"} and split["behavior"] == "Removed" and split["invert"]
        named = all(not a[x] for a in file["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized"))
        if not (plain and shaped and named and level["type"] == "ByteLevel" and not level["use_regex"]) or file["decoder"]:
            raise ValueError("this tokenizer file has parts that are not supported")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        specials = {a["content"]: a["id"] for a in file["added_tokens"]}
        suffix = model["end_of_word_suffix"] or ""
        self.automaton = MergeAutomaton({k: i for k, i in model["vocab"].items() if k not in specials}, merges, suffix)
        self.names = {i: label for label, i in model["vocab"].items()} | {i: label for label, i in specials.items()}
        self.numbers = {i: str(i) for i in self.names}
        self.specials = specials
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.pattern = regex.compile(split["pattern"]["Regex"])
        library = tokenizers.Tokenizer.from_str(content.decode())
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.symbols = {byte: symbol for byte, symbol in enumerate(byte_symbols()) if chr(byte) != symbol}
        self.words: dict[str, list[int]] = {}

    def _chunk(self, chunk: str) -> list[int]:
        """Encode what stands between two spaces; words never reach over white space."""
        if len(self.words) >= KEPT_WORDS:
            for old in list(self.words)[: KEPT_WORDS // 2]:
                del self.words[old]
        if chunk.isascii():
            # Printable ASCII stands for itself; control characters have symbols of their own.
            split = [chunk.lower()] if chunk.isalpha() else self.pattern.findall(chunk.lower())
            if not chunk.isprintable():
                split = [word.translate(self.symbols) for word in split]
        elif LATIN.fullmatch(chunk):  # letters in every version of the tables, which no normaliser but lower case changes
            split = [chunk.lower()] if chunk.isalpha() else self.pattern.findall(chunk.lower())
            split = [word if word.isascii() else word.encode().decode("latin-1").translate(self.symbols) for word in split]
        else:  # which characters are letters depends on the library's tables
            split = [word for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))]
        if len(split) == 1:
            ids = self.automaton.encode(split[0])
        else:
            ids = []
            for word in split:
                ids += self.automaton.encode(word)
        self.words[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if self.special and self.special.search(text):
            ids: list[int] = []
            for i, part in enumerate(self.special.split(text)):
                ids += [self.specials[part]] if i % 2 else self._plain(part)
            return ids
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        ids: list[int] = []
        known = self.words.get
        for chunk in text.replace("\n", " ").split(" "):
            if chunk:
                found = known(chunk)
                ids += self._chunk(chunk) if found is None else found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs; a file without decoder sets a space between them."""
        return " ".join(map(self.names.__getitem__, ids))

    def listed(self, ids: list[int]) -> str:
        return " ".join(map(self.numbers.__getitem__, ids))


@lru_cache(maxsize=2)
def _tokenizer(digest: str, content: bytes) -> Tokenizer:
    return Tokenizer(content)


#: Columns that ``encode_texts`` can add, with their types.
OUTPUTS = {
    "n_tokens": ("bigint", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("string", pa.string()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def encode_texts(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids"), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode each whole text, decode the ids again, and return the asked outputs per row.

    One row out per row in, repeated rows and rows with null keys included; columns besides ``keep``
    and ``text`` are not read. A null text is empty: no ids, and the empty text decoded. The work is
    one pass without a shuffle. A worker compiles the vocabulary once and keeps a bounded number of
    encoded words and steps of the walk; a text of any length is encoded whole.
    """
    sent = send(docs.sparkSession, content := read_file(path))
    digest = hashlib.sha256(content).hexdigest()
    rows = docs.select(*[column(c) for c in keep], text_of().alias("text" if "text" not in keep else "text_"))
    text = rows.columns[-1]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), *(f"`{c}` {OUTPUTS[c][0]}" for c in outputs)])
    decodes = any(c.startswith("decoded") for c in outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(digest, sent.value)
        for batch in slices(batches, text):
            made: dict[str, list] = {c: [] for c in outputs}
            for value in batch.column(batch.num_columns - 1).to_pylist():
                ids = tokenizer.encode(value)
                decoded = tokenizer.decode(ids) if decodes else ""
                for c, values in made.items():
                    if c == "n_tokens":
                        values.append(len(ids))
                    elif c == "ids":
                        values.append(ids)
                    elif c == "decoded":
                        values.append(decoded)
                    elif c == "ids_sha256":
                        values.append(hashlib.sha256(tokenizer.listed(ids).encode()).hexdigest())
                    else:
                        values.append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(values, OUTPUTS[c][1]) for c, values in made.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *outputs])

    return rows.mapInArrow(run, schema)


def op9_bpe(spark, folder: str, path: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return encode_texts(docs, path, ("n_tokens", "ids_sha256", "decoded_sha256"))
