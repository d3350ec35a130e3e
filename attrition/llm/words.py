"""Words of many texts at once: lower-cased ASCII, split at ASCII white space, hashed to 64 bits."""

from __future__ import annotations

import hashlib

import numpy as np

from attrition.llm.common import U64, mix

STEP = U64(0xD6E8FEB86659FD93)
LONG = 256      # bytes; longer words are hashed one by one


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of each text).

    A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.  Its hash takes eight bytes at a
    time, each mixed before the next, so words of one length up to eight bytes never share a hash
    and longer ones do so by chance only; words over ``LONG`` bytes take half of a BLAKE2 digest.
    """
    data = [t.encode().lower() for t in texts]      # of bytes: A-Z only
    sizes = np.array([len(d) + 1 for d in data], np.int64)
    joined = b"\n".join(data) + b"\n" + bytes(8)
    raw = np.frombuffer(joined, np.uint8)[:-8]
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    per_text = np.diff(np.searchsorted(starts, np.append(0, np.cumsum(sizes)))) if data else np.zeros(0, np.int64)
    lengths = ends - starts
    lanes = np.ndarray((len(raw),), "<u8", joined, strides=(1,))    # the eight bytes from every place
    hashes = mix(lengths.astype(U64) * STEP)
    live = np.flatnonzero(lengths <= LONG)
    at = 0
    while len(live):
        left = lengths[live] - at
        spare = U64(8) * (U64(8) - np.minimum(left, 8).astype(U64))
        lane = lanes[starts[live] + at] << spare        # bytes of the next word drop out
        hashes[live] = mix((hashes[live] ^ lane) + STEP)
        at += 8
        live = live[left > 8]
    for k in np.flatnonzero(lengths > LONG).tolist():
        digest = hashlib.blake2b(joined[starts[k]:ends[k]], digest_size=8).digest()
        hashes[k] = U64(int.from_bytes(digest, "little"))
    return hashes, per_text


def doc_numbers(per_text: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(per_text)), per_text)
