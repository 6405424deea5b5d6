"""Token ids of whole texts by a ``tokenizers`` file, with a bounded table of words seen.

For a tokenizer that drops white space, text between two white spaces is encoded on its own, so a
worker keeps the ids of words it has met and only encodes new ones.  A new plain word (ASCII and
Latin-1 letters) is cut into the pre-tokenizer's pieces, which are words themselves; any other
word (combining marks, other scripts, special-token text) goes to the library as it stands.
A tokenizer of another build is applied to whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from airshed.llm.common import worker_cache

#: Words kept per Python worker before the table starts anew (a memory bound of some 200 MB).
TABLE_WORDS = 1_000_000
LETTERS = "a-zß-öø-ÿ"
PIECE = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Texts of plain words only, and a comma or full stop that shares its piece with another sign.
PLAIN_TEXT = re.compile("[ \t\n\r!-~À-ÖØ-öø-ÿ]*")
JOINED_SIGN = re.compile("[^A-Za-z0-9À-ÖØ-öø-ÿ \t\n\r][,.](?![^ \t\n\r])")
#: White space for str.split() but not for the tokenizer.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: The build for which words are independent: fixed values to compare with.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The byte-level pre-tokenizer's letter for each byte: printable Latin-1 stands for itself, the
    others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """word -> ids; a word that is missing is encoded when it is first looked up."""

    def __init__(self, tok):
        super().__init__()
        self.tok, self.model, self.letters = tok, tok.model, byte_letters()

    def __missing__(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and "<|" not in word:
            pieces = [word.lower()] if word.isalpha() else PIECE.findall(word.lower())
            if len(pieces) > 1:
                ids = b"".join([self[p] for p in pieces])
            else:  # one piece: straight to the merges
                p = pieces[0]
                found = self.model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(self.letters))
                ids = array("I", [t.id for t in found]).tobytes()
        else:
            ids = array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm, pre, model = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}, spec["model"]
        parts = pre.get("pretokenizers") or [{}]
        self.by_word = (
            [n["type"] for n in norm.get("normalizers", [])] == NORMALIZERS
            and norm["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and norm["normalizers"][1]["content"] == " "
            and parts[0].get("pattern") == {"Regex": SPLIT_PATTERN} and parts[0].get("behavior") == "Removed"
            and [p["type"] for p in parts] == ["Split", "ByteLevel"] and not parts[1].get("use_regex")
            and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not model["dropout"])
        self.words = Words(self.tok)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def split(self, text: str) -> list[str] | None:
        """Words of a text that are encoded independently of each other; None: only the whole text is right.

        A plain text is lower-cased first, and a comma or full stop at the end of a word, which the
        pre-tokenizer cuts off anyway, becomes a word: fewer distinct words are met.
        """
        if PLAIN_TEXT.fullmatch(text) and "<|" not in text and not JOINED_SIGN.search(text):
            return text.lower().replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ").split()
        return None if ODD_SPACE.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.words) > TABLE_WORDS:
            self.words.clear()
        get, out = self.words.__getitem__, []
        for t in texts:
            words = self.split(t) if self.by_word else None
            out.append(self._whole(t) if words is None else b"".join(map(get, words)))
        return out


def tokenizer(path: str) -> WordTokenizer:
    kept = worker_cache("word_tokens")
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]
