"""Byte-level BPE: texts to token ids and back.

Texts are split by a pattern; the distinct pieces that a task has not met before are
merged together, as one corpus: an index from pairs to the places where they stand is
worked off in rank order, and each merge touches the neighbours of its places only. What
a piece became is kept, so every further occurrence costs one lookup. Nothing is
shuffled: a task needs its own texts and the vocabulary, whose size does not grow with
the data.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from types import SimpleNamespace

import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Letters and numbers that the installed pattern library knows and tiktoken's splitter
# (Unicode 16) takes for unassigned. Ranges of code points, both ends included.
UNASSIGNED = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]

# Matches taken at a time: bounds what a very long text holds in a task.
PIECES = 1 << 17

# Pairs whose ranks a task remembers.
PAIRS = 1 << 20

# What a task remembers of pieces, in characters; then it starts anew.
REMEMBERED = 1 << 25


def vocabulary(name: str = VOCABULARY) -> dict[bytes, int]:
    """The ranks of a public tokenizer's file: bytes of each token and its number."""
    with open(public_tokenizers.path(name), "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def kernel(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> SimpleNamespace:
    """The functions that run inside tasks; they hold the vocabulary and nothing of the data."""
    tokens = {rank: token for token, rank in ranks.items()}
    single = [ranks[bytes([b])] for b in range(256)]
    unassigned = UNASSIGNED

    def splitter():
        """Function from a text to lists of its matches, each at most ``PIECES`` long."""
        import re
        from itertools import islice

        import regex

        # Letters and numbers, without those that tiktoken's splitter doesn't know yet.
        newer = "".join(f"{chr(a)}-{chr(b)}" for a, b in unassigned)
        exact = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])")
        for kind in "LN":
            exact = exact.replace(rf" ?\p{{{kind}}}+", rf" ?(?:(?![{newer}])\p{{{kind}}})+")
        usual, rare, any_newer = regex.compile(pattern), regex.compile(exact), re.compile(f"[{newer}]")

        def pieces(text: str) -> Iterator[list[str]]:
            found = usual if text.isascii() or not any_newer.search(text) else rare
            if len(text) <= PIECES:
                yield found.findall(text)
                return
            matches = (m[0] for m in found.finditer(text))
            while part := list(islice(matches, PIECES)):
                yield part

        return pieces

    class Ranks(dict):
        """The rank of what two neighbours make, found once per pair; ``none`` if it is no token."""

        def __missing__(self, pair):
            if len(self) >= PAIRS:
                self.clear()
            left, right = pair
            rank = none if left < 0 or right < 0 else ranks.get(tokens[left] + tokens[right], none)
            self[pair] = rank
            return rank

    gap, gone, none = -1, -2, 1 << 60
    rank_of = Ranks()

    def replay(words: list[bytes]) -> list[bytes]:
        """The tokens of many words, 32 bits each: every merge in rank order, wherever its pair stands."""
        import numpy as np
        from heapq import heapify, heappop, heappush

        # All words in one row, a gap after each; pairs never reach over a gap.
        row = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
        gaps = np.cumsum([0, *(len(w) + 1 for w in words)])
        codes = np.array(single, np.int64)[row]
        codes[gaps] = gap
        at = codes.tolist()
        before = list(range(-1, len(at) - 1))
        after = list(range(1, len(at) + 1))

        # The index from pairs, by the rank of what they make, to their places.
        pairs, which = np.unique((codes[:-1] + 1) << 32 | (codes[1:] + 1), return_inverse=True)
        first = np.array([rank_of[(p >> 32) - 1, (p & 0xFFFFFFFF) - 1] for p in pairs.tolist()], np.int64)[which]
        order = np.argsort(first, kind="stable")
        order = order[: np.searchsorted(first[order], none)]
        starts = np.flatnonzero(np.diff(first[order], prepend=-1))
        places = {int(first[part[0]]): part.tolist() for part in np.split(order, starts[1:]) if len(part)}
        waiting = list(places)
        heapify(waiting)

        def stands(r, i):
            if r in places:
                places[r].append(i)
            else:
                places[r] = [i]
                heappush(waiting, r)

        while waiting:
            r = heappop(waiting)
            found = sorted(places.pop(r))
            for n, i in enumerate(found):
                j = after[i]
                if at[i] < 0 or rank_of[at[i], at[j]] != r:
                    continue
                at[i], at[j] = r, gone
                j = after[i] = after[j]
                before[j], h = i, before[i]
                left, right = rank_of[at[h], r], rank_of[r, at[j]]
                if left != none:
                    stands(left, h)
                if right != none:
                    stands(right, i)
                if left < r or right < r:
                    # The word goes on with the lower rank; the rest of this one waits.
                    for k in found[n + 1 :]:
                        stands(r, k)
                    break
        made = np.array(at, np.int32)
        ends = np.cumsum(made >= 0)[gaps] * 4
        ids = made[made >= 0].tobytes()
        return [ids[i:j] for i, j in zip(ends.tolist(), ends[1:].tolist())]

    def encoder():
        """Function from many texts to the bytes of their ids (32 bits each)."""
        import numpy as np

        pieces, kept, size = splitter(), {}, 0

        def learn(met: set[str]) -> None:
            """Give every piece its ids: those that are new are merged together."""
            nonlocal size
            if size > REMEMBERED:
                kept.clear()
                size = 0
            merged, spelled = [], []
            for piece in met.difference(kept):
                size += len(piece)
                data = piece.encode()
                whole = ranks.get(data)
                if whole is None:
                    merged.append(piece)
                    spelled.append(data)
                else:
                    kept[piece] = np.int32(whole).tobytes()
            for piece, ids in zip(merged, replay(spelled)):
                kept[piece] = ids

        def encoded(texts: list[str | None]) -> list[bytes]:
            out, held, count = [[] for _ in texts], [], 0

            def settle():
                learn(set().union(*(found for _, found in held)))
                for n, found in held:
                    out[n].append(b"".join(map(kept.__getitem__, found)))
                held.clear()

            for n, text in enumerate(texts):
                for found in pieces(text or ""):
                    held.append((n, found))
                    count += len(found)
                    if count >= PIECES:
                        settle()
                        count = 0
            settle()
            return [b"".join(parts) for parts in out]

        return encoded

    def decoded(ids) -> bytes:
        return b"".join(
            b"".join(map(tokens.__getitem__, ids[i : i + PIECES].tolist())) for i in range(0, len(ids), PIECES)
        )

    return SimpleNamespace(replay=replay, splitter=splitter, encoder=encoder, decoded=decoded)


def token_ids(text: Column, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> Column:
    """The ids of a text's tokens as an array column.

    Each match of ``pattern`` stands alone: it is one token if it is in the vocabulary,
    otherwise its bytes are merged by ascending rank, leftmost first. Special tokens are
    ordinary text. Null and empty texts have no ids. Equal texts have equal ids, whatever
    else the table holds, so repeated rows, ties and the order of rows change nothing; an
    empty table gives an empty column. A very long text is split and merged 131,072 matches
    at a time; one match without a break is merged whole, in memory of some hundred times
    its bytes.
    """
    k = kernel(ranks, pattern)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        encoded = k.encoder()
        for texts in batches:
            parts = encoded(texts.to_pylist())
            ends = np.cumsum([0, *(len(part) // 4 for part in parts)]).astype(np.int32)
            flat = np.frombuffer(b"".join(parts), np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return F.arrow_udf(encode, T.ArrayType(T.IntegerType()))(text)


def token_bytes(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for: the text in UTF-8 for the ids of a whole text.

    Null or no ids give no bytes. An id outside the vocabulary is an error.
    """
    k = kernel(ranks)

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        for lists in batches:
            flat = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            empty = lists.is_null().to_numpy(zero_copy_only=False)
            yield pa.array(
                [b"" if gone else k.decoded(flat[a:b]) for a, b, gone in zip(ends[:-1], ends[1:], np.asarray(empty))],
                pa.binary(),
            )

    return F.arrow_udf(decode, T.BinaryType())(ids)


def encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", ids: str = "token_ids") -> DataFrame:
    """The documents with the ids of their tokens; a column of that name is replaced.

    All other columns stay as they are, whatever their names. See ``token_ids``.
    """
    return docs.withColumn(ids, token_ids(F.col(f"`{text}`"), ranks))


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids: str = "token_ids", data: str = "decoded") -> DataFrame:
    """The table with the bytes of its ids; a column of that name is replaced. See ``token_bytes``."""
    return tokens.withColumn(data, token_bytes(F.col(f"`{ids}`"), ranks))
