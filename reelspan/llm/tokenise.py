"""Tokenizers of public vocabularies on the workers.

The vocabulary's bytes travel in a broadcast variable (their size is that of
the file, whatever the corpus holds), so no executor needs the file itself.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import unicodedata
from array import array
from dataclasses import dataclass
from pathlib import Path

from pyspark import Broadcast
from pyspark.sql import SparkSession

from ..session import ship_package

#: Signs of which one stands between words that are encoded together.
MARKS = ("\u00a7", "\u00b6", "\u2020", "\u00a4", "|", "~", "^")
#: Distinct words a worker remembers at a time; a speed setting without effect on results.
MEMO = 800_000


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file: its kind by suffix, its digest and its bytes."""

    kind: str
    digest: str
    data: Broadcast

    @staticmethod
    def load(spark: SparkSession, path: str) -> Vocabulary:
        data = Path(path).read_bytes()
        return Vocabulary(Path(path).suffix, hashlib.sha256(data).hexdigest(), ship_package(spark).sparkContext.broadcast(data))


def ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def _json_encoder(data: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data.decode())
    return lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def _piece_encoder(data: bytes):
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_proto=data)
    return lambda texts: p.encode(texts, num_threads=1)


def splits_at_spaces(data: bytes) -> bool:
    """Whether a JSON tokenizer treats each space-separated word by itself, and runs of
    letters and of signs in it: its normaliser turns white space into a space and
    lowers case, its pre-tokenizer splits such runs, and no added token has spaces."""
    spec = json.loads(data)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    lowered = any(s.get("type") == "Lowercase" for s in steps)
    pattern = str((split.get("pattern") or {}).get("Regex"))
    letters = "[\\p{L}]+|" in pattern and "[^\\s\\p{L}\\p{N}]+" in pattern
    spaced = lowered and letters and any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " " for s in steps)
    return spaced and split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed" and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", []))


def _parts(word: str) -> tuple[str, ...]:
    """Parts of a word that are encoded by themselves: full stops and commas after a
    letter are a pre-token of their own, and letters of ASCII alone are lowered."""
    core = word.rstrip(".,")
    if not core or not unicodedata.normalize("NFC", core[-1]).lower()[-1].isalpha():
        return (word,)
    tail = word[len(core) :]
    if core.isascii() and core.isalpha():
        core = core.lower()
    return (core, tail) if tail else (core,)


#: Words of letters that are one code point each in every normal form, and have one lower case.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def _word_model(data: bytes):
    """The ids of a word of lower-case ``_LETTERS`` by the merges alone, where a JSON
    tokenizer does nothing else with it: it maps bytes to signs and then merges. None for
    other tokenizers."""
    spec = json.loads(data)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    normal = (spec.get("normalizer") or {}).get("normalizers") or []
    plain = len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex")
    if not plain or {n.get("type") for n in normal} != {"NFC", "Replace", "Lowercase"} or spec.get("model", {}).get("type") != "BPE" or spec.get("post_processor"):
        return None
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(data.decode())
    merge = whole.model.tokenize
    # signs of bytes: printable ones stand for themselves, others follow from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}

    def ids(word: bytes) -> list[int]:
        text = word.decode() if word.isalpha() else "".join(map(sign.__getitem__, word))
        return [t.id for t in merge(text)]

    words = ["a", "the", "tokenization", "\u00e9t\u00e9", "\u00fcber", "stra\u00dfe", "\u00ff\u00e0x", "7", "\u00bd", "'s", "'ll", "...", "?!\u00bb", "\x00\x7f\u00ad"]
    return ids if all(ids(w.encode()) == whole.encode(w, add_special_tokens=False).ids for w in words) else None


#: The split that ``_PRETOKENS`` makes of lower-case Latin-1, and the letters, numbers and
#: white space in it.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_L, _N, _S = rb"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", rb"0-9\xb2\xb3\xb9\xbc-\xbe", rb"\x09-\x0d\x20\x85\xa0"
_PRETOKENS = re.compile(rb"[%b]+|'(?:s|t|re|ve|m|ll|d)|[%b]|[^%b]+" % (_L, _N, _S + _L + _N))
_LOWER = bytes(ord(chr(i).lower()) for i in range(256))


def _special_in_latin(data: bytes) -> list[bytes] | None:
    """The added tokens of a JSON tokenizer that Latin-1 can hold, in lower case, if it does
    nothing before its merges but lower texts of Latin-1 (which are in normal form) and cut
    them by ``_SPLIT``; else None. For tokenizers that ``splits_at_spaces`` and
    ``_word_model`` take."""
    spec = json.loads(data)
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    if split.get("pattern") != {"Regex": _SPLIT} or len(spec["normalizer"]["normalizers"]) != 3:
        return None
    added = [t["content"] for t in spec.get("added_tokens", [])]
    return [c.encode("latin-1").translate(_LOWER) for c in added if max(c) <= "\xff"]


class _Merged(dict):
    """Ids of pre-tokens of Latin-1, by the merges when they are first asked for."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, token: bytes) -> bytes:
        found = self[token] = array("I", self.merge(token if token.isascii() else token.decode("latin-1").encode())).tobytes()
        return found


def _byte_parts(word: bytes) -> tuple[bytes, ...]:
    """``_parts`` of a word in UTF-8, without decoding what is ASCII letters."""
    core = word.rstrip(b".,")
    if core.isalpha():
        return (core.lower(), word[len(core) :]) if len(core) < len(word) else (core.lower(),)
    text = core.decode("utf-8", "replace")
    if _LETTERS.fullmatch(text):
        return (text.lower().encode(), word[len(core) :]) if len(core) < len(word) else (text.lower().encode(),)
    return tuple(p.encode() for p in _parts(word.decode("utf-8", "replace")))


class WordEncoder:
    """Ids of texts by a tokenizer that treats space-separated words by themselves.

    Each distinct word is encoded once while it is remembered; a text's ids
    are those of its words in a row, which is what the library returns for
    the whole text. For other tokenizers whole texts are encoded. Texts of Latin-1
    without added tokens are cut into pre-tokens here, where the tokenizer's split is
    known, and those go to the merges alone. Of other texts' unknown words, those of
    plain letters go to the merges alone, the others are handed to the library many in
    a row, with a mark between them whose one id shows where a word ends.
    """

    def __init__(self, kind: str, data: bytes):
        self.encode = _piece_encoder(data) if kind == ".model" else _json_encoder(data)
        self.by_word = kind == ".json" and splits_at_spaces(data)
        self.memo: dict[bytes, bytes] = {}
        self.mark = next(((m, ids[0]) for m in MARKS if len(ids := self.encode([m])[0]) == 1), None) if self.by_word else None
        self.merge = _word_model(data) if self.by_word else None
        self.special = _special_in_latin(data) if self.merge else None
        self.merged = _Merged(self.merge)

    def _learn(self, words: list[bytes]) -> None:
        import numpy as np

        if self.merge:
            known = {w: array("I", self.merge(w)).tobytes() for w in words if w.isalpha() or _LETTERS.fullmatch(w.decode())}
            self.memo.update(known)
            words = [w for w in words if w not in known]
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            if self.mark:
                flat = np.asarray(self.encode([f" {self.mark[0]} ".join([w.decode() for w in some])])[0], "<u4")
                ends = np.flatnonzero(flat == self.mark[1])
                # a word that has the mark's id itself makes one too many
                if len(ends) == len(some) - 1:
                    data = flat.tobytes()
                    at = [-4, *(4 * ends).tolist(), len(data)]
                    self.memo.update((w, data[a + 4 : b]) for w, a, b in zip(some, at, at[1:], strict=False))
                    continue
            self.memo.update((w, array("I", x).tobytes()) for w, x in zip(some, self.encode([w.decode() for w in some]), strict=True))

    def _latin_ids(self, text: str) -> bytes | None:
        """A text's ids by its pre-tokens; None where it isn't Latin-1 or may have an added token."""
        try:
            low = text.encode("latin-1").translate(_LOWER)
        except UnicodeEncodeError:
            return None
        if any(s in low for s in self.special):
            return None
        return b"".join(map(self.merged.__getitem__, _PRETOKENS.findall(low)))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers; null is empty."""
        import numpy as np

        texts = [t or "" for t in texts]
        if not self.by_word:
            return [np.asarray(x, "<u4").tobytes() for x in self.encode(texts)]
        if len(self.memo) + len(self.merged) > MEMO:
            self.memo.clear()
            self.merged.clear()
        if self.special is None:
            return self._ids_by_word(texts)
        found = [self._latin_ids(t) for t in texts]
        rest = iter(self._ids_by_word([t for t, x in zip(texts, found, strict=True) if x is None]))
        return [next(rest) if x is None else x for x in found]

    def _ids_by_word(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        new = {w: _byte_parts(w) for w in set().union(*split).difference(memo)}
        self._learn(list(set().union(*new.values()).difference(memo)))
        for w, own in new.items():
            memo[w] = memo[own[0]] if len(own) == 1 else b"".join([memo[p] for p in own])
        get = memo.__getitem__
        return [b"".join(map(get, ws)) for ws in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(v: Vocabulary) -> WordEncoder:
    """This worker's encoder for a vocabulary; kept from task to task."""
    if v.digest not in _encoders:
        _encoders[v.digest] = WordEncoder(v.kind, v.data.value)
    return _encoders[v.digest]
