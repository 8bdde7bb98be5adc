"""Tokenizer access with memoised chunks.

A text is cut where the tokenizer's own pre-tokenizer always cuts, so that the ids of
the chunks, joined, are the ids of the whole text; each worker keeps a bounded table of
chunks that it has already encoded. ``tests/llm`` holds this against the library.
"""

from __future__ import annotations

import os
import re

import numpy as np

from ravelin.llm.common import worker_cache

#: The White_Space property, as the pre-tokenizers' \s understands it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters of Latin-1: a run of them before white space or ASCII punctuation is a pre-token.
LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
#: Chunks a worker keeps (about 200 bytes each); what comes later is encoded each time.
CACHE_ENTRIES = 800_000
#: Longer chunks are encoded each time.
CACHE_CHARS = 80


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    kind ``byte``: byte-level BPE that keeps white space, a leading blank belongs to the
    next word. kind ``word``: white space is dropped. Null is treated as the empty text.
    """

    def __init__(self, path: str, kind: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        word = f"[{LETTERS}]+(?=[{SPACE}!-@\\[-`{{-~]|$)"
        keep = f" ?{word}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        self.find = re.compile(keep if kind == "byte" else f"{word}|[^{SPACE}]+").findall
        self.kind = kind
        vocabulary = self.tokenizer.get_vocab()
        self.edges = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edges[[i for x, i in vocabulary.items() if (x.startswith("\u0120") if kind == "byte" else x.endswith("</w>"))]] = True
        self.ids: dict[str, bytes] = {}
        self.spans: dict[str, tuple[bytes, bytes, int]] = {}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = self.find(text)
        found = list(map(self.ids.get, parts))
        if None not in found:
            return b"".join(found)
        places = [i for i, f in enumerate(found) if f is None]
        fresh = dict.fromkeys([parts[i] for i in places])
        here = self.encode_words([p for p in fresh if self.is_word(p)])
        rest = [p for p in fresh if p not in here]
        if rest:
            for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
                here[p] = np.array(e.ids, "<u4").tobytes()
        for i in places:
            found[i] = here[parts[i]]
        if len(self.ids) < CACHE_ENTRIES:
            self.ids.update((p, v) for p, v in here.items() if len(p) <= CACHE_CHARS)
        return b"".join(found)

    def is_word(self, chunk: str) -> bool:
        """A single pre-token of Latin-1 letters, after its blank for kind ``byte``."""
        return (chunk[0] == " " and chunk[1:].isalpha() if self.kind == "byte" else chunk.isalpha()) and max(chunk) <= "\xff"

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words in one call: the first id of a pre-token with a blank, or the last one
        of a pre-token in a vocabulary with word ends, can stand nowhere else."""
        if not words:
            return {}
        byte = self.kind == "byte"
        ids = np.array(self.tokenizer.encode(("" if byte else " ").join(words), add_special_tokens=False).ids, "<u4")
        edge = np.flatnonzero(self.edges[ids])
        cut = np.append(edge, len(ids)) if byte else np.append(0, edge + 1)
        if len(cut) != len(words) + 1:
            return {}
        raw, at = ids.tobytes(), (cut * 4).tolist()
        return {w: raw[at[i] : at[i + 1]] for i, w in enumerate(words)}

    def token_spans(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Start and end character of every token of the whole text, in token order."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = self.find(text)
        known, here = self.spans, {}
        fresh = list({p for p in parts if p not in known})
        if fresh:
            for p, e in zip(fresh, self.tokenizer.encode_batch(fresh, add_special_tokens=False), strict=True):
                at = np.array(e.offsets, "<i4").reshape(-1, 2)
                here[p] = (at[:, 0].tobytes(), at[:, 1].tobytes(), len(at))
            if len(known) < CACHE_ENTRIES // 4:
                known.update((p, v) for p, v in here.items() if len(p) <= CACHE_CHARS)
        found = [here[p] if p in here else known[p] for p in parts]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        begin = np.repeat(np.cumsum(size) - size, np.fromiter((f[2] for f in found), np.int64, len(found)))
        joined = [np.frombuffer(b"".join([f[i] for f in found]), "<i4") + begin for i in (0, 1)]
        return joined[0], joined[1]


def encoder(path: str, kind: str) -> ChunkEncoder:
    """One encoder per worker process, kept between its tasks."""
    made = worker_cache("tokens")
    if (path, kind) not in made:
        made[path, kind] = ChunkEncoder(path, kind)
    return made[path, kind]
