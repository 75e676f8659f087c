"""CRC-32C of many byte strings at once, and the masked form kept beside data that holds checksums itself."""

from __future__ import annotations

import numpy as np

from millrace.llm.common import bounds, ragged

BLOCK = 256
MASK_DELTA = 0xA282EAD8  # fixed value of the record format


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC of (byte, then k zero bytes) for k below 8, and what `BLOCK` zero bytes make of each byte of a CRC."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0x82F63B78), one >> 1)
    steps = [one]
    for _ in range(7):
        steps.append(steps[0][steps[-1] & 0xFF] ^ (steps[-1] >> 8))
    shift = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(BLOCK):
        shift = one[shift & 0xFF] ^ (shift >> 8)
    return np.stack(steps), shift


STEPS, SHIFT = _tables()


def crc32c(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32C of consecutive strings in `data` (bytes) of the given sizes, each of at least 4 bytes.

    Leading zeros do not change a CRC that starts at 0, so each string is filled up in front to whole blocks; the usual
    start value is the same as flipping the first four bytes. Blocks are summed side by side, then joined in order.
    """
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint32)
    if sizes.min() < 4:
        raise ValueError("strings of at least 4 bytes are needed")
    blocks = -(-sizes // BLOCK)
    block_at = bounds(blocks)
    filled = np.zeros(int(block_at[-1]) * BLOCK, np.uint8)
    begin = block_at[1:] * BLOCK - sizes
    filled[ragged(begin, sizes)] = data
    for k in range(4):
        filled[begin + k] ^= 0xFF
    words = filled.view("<u4").reshape(-1, BLOCK // 4)
    part = np.zeros(len(words), np.uint32)
    for k in range(0, BLOCK // 4, 2):
        low, high = words[:, k] ^ part, words[:, k + 1]
        part = STEPS[7][low & 0xFF] ^ STEPS[6][low >> 8 & 0xFF] ^ STEPS[5][low >> 16 & 0xFF] ^ STEPS[4][low >> 24]
        part ^= STEPS[3][high & 0xFF] ^ STEPS[2][high >> 8 & 0xFF] ^ STEPS[1][high >> 16 & 0xFF] ^ STEPS[0][high >> 24]
    total = part[block_at[:-1]]
    order = np.argsort(-blocks, kind="stable")
    for k in range(1, int(blocks.max())):
        own = order[: np.searchsorted(-blocks[order], -k, side="left")]
        old = total[own]
        moved = SHIFT[0][old & 0xFF] ^ SHIFT[1][old >> 8 & 0xFF] ^ SHIFT[2][old >> 16 & 0xFF] ^ SHIFT[3][old >> 24]
        total[own] = moved ^ part[block_at[own] + k]
    return total ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    crc = np.asarray(crc, np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
