"""Token ids by a public tokenizer file, with a bounded memory of words seen before."""

from __future__ import annotations

import os
import string
import unicodedata

import numpy as np
import public_tokenizers

#: Words whose ids a worker process remembers.
REMEMBERED = 400_000
#: White space to Python's ``split`` but not to the tokenizers.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class WordTokenizer:
    """Ids of whole texts, equal to those of the library without added tokens.

    The tokenizer splits at white space, and there between letters and other characters.
    A text's ids are those of its words one after the other, and a word seen before need not
    be encoded again. New words of letters skip the library's splitting and go straight to
    its merges, many at a time; all others go through the whole library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.lowered = Tokenizer(self.library.model)
        self.lowered.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = Tokenizer(self.library.model)
        self.letters.normalizer = normalizers.Lowercase()
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.stops = np.zeros(len(self.ends), bool)
        for token, i in vocabulary.items():
            body = token.removesuffix("</w>")
            self.ends[i] = body != token
            self.stops[i] = self.ends[i] and body[-1:] in (".", "!", "?")

    def _one(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, words: list[str], tokenizer) -> list[bytes]:
        """Of words of letters only: encoded as one text, cut where a token ends a word."""
        found: list[bytes] = []
        for at in range(0, len(words), 5000):
            part = words[at:at + 5000]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                data, bounds = ids.tobytes(), [0, *(cuts * 4).tolist()]
                found += [data[a:b] for a, b in zip(bounds, bounds[1:])]
            else:
                found += [self._one(w) for w in part]
        return found

    def _encode(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not known."""
        made, heads, tails = {}, {}, {}
        for word in words:
            head = word.rstrip(string.punctuation)
            if head.isascii():
                if head.isalpha():
                    heads[word] = head.lower()
                    tails[word] = word[len(head):]
                    continue
            elif head.isalpha() and head.lower().isalpha() and unicodedata.is_normalized("NFC", head):
                heads[word], tails[word] = head, word[len(head):]
                continue
            made[word] = self._one(word)
        new = set(heads.values())
        plain = [h for h in new if h.isascii()]
        other = list(new.difference(plain))
        body = dict(zip(plain, self._plain(plain, self.lowered)))
        body.update(zip(other, self._plain(other, self.letters)))
        end = {t: self._one(t) if t else b"" for t in set(tails.values())}
        for word, head in heads.items():
            made[word] = body[head] + end[tails[word]]
        return made

    def ids(self, texts: list[str]) -> list[bytes]:
        """Of each text the ids as bytes of little-endian 32-bit numbers."""
        get, found, open_texts, missing = self.known.get, [], [], set()
        for n, text in enumerate(texts):
            if any(c in text for c in SEPARATORS):
                found.append(self._one(text))
                continue
            words = text.split()
            parts = list(map(get, words))
            if None in parts:
                gaps = [i for i, p in enumerate(parts) if p is None]
                missing.update(words[i] for i in gaps)
                open_texts.append((n, words, parts, gaps))
                found.append(b"")
            else:
                found.append(b"".join(parts))
        if missing:
            made = self._encode(missing)
            for n, words, parts, gaps in open_texts:
                for i in gaps:
                    parts[i] = made[words[i]]
                found[n] = b"".join(parts)
            room = REMEMBERED - len(self.known)
            if room > 0:
                self.known.update(made if len(made) <= room else list(made.items())[:room])
        return found


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per file and worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)
