"""Covering codes over 32-bit words, used as anchor points for Hamming search.

A 32-bit word is split into a perfect binary Golay block (23 bits, covering
radius 3), a perfect Hamming block (7 bits, radius 1) and two plain bits
(radius 0). The product of the three codes has 2^(12 + 4 + 2) = 2^18 anchors,
and every word has exactly one anchor within the radii: its home.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# Block lengths, covering radii, generator polynomial of the binary Golay code.
GOLAY_BITS, GOLAY_RADIUS, GOLAY_POLYNOMIAL = 23, 3, 0b101011100011
HAMMING_BITS, HAMMING_RADIUS = 7, 1
PLAIN_BITS = 2


def _golay_syndrome(word: int) -> int:
    for i in range(GOLAY_BITS - 1, 10, -1):
        if word >> i & 1:
            word ^= GOLAY_POLYNOMIAL << (i - 11)
    return word


def _hamming_syndrome(word: int) -> int:
    out = 0
    for i in range(HAMMING_BITS):
        if word >> i & 1:
            out ^= i + 1
    return out


class Block:
    """Error patterns of one block, by syndrome, up to covering radius + excess."""

    def __init__(self, bits: int, radius: int, redundancy: int, syndrome, excess: int):
        self.bits = bits
        rows: list[list[tuple[int, int]]] = [[] for _ in range(1 << redundancy)]
        for weight in range(radius + excess + 1):
            for places in combinations(range(bits), weight):
                pattern = sum(1 << p for p in places)
                rows[syndrome(pattern)].append((max(0, weight - radius), pattern))
        width = max(map(len, rows))
        self.cost = np.full((len(rows), width), 99, np.uint8)
        self.pattern = np.zeros((len(rows), width), np.uint32)
        for s, row in enumerate(rows):
            for j, (cost, pattern) in enumerate(row):
                self.cost[s, j], self.pattern[s, j] = cost, pattern
        # syndromes are linear: one lookup per byte of the word
        unit = [syndrome(1 << i) for i in range(bits)]
        self.tables = []
        for at in range(0, bits, 8):
            table = np.zeros(256, np.int64)
            for byte in range(256):
                for i in range(8):
                    if byte >> i & 1 and at + i < bits:
                        table[byte] ^= unit[at + i]
            self.tables.append(table)

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for i, table in enumerate(self.tables):
            out ^= table[(words >> np.uint32(8 * i)) & np.uint32(255)]
        return out


class AnchorCode:
    """Anchors of 32-bit words within covering radius + ``excess`` differing bits."""

    def __init__(self, excess: int):
        self.excess = excess
        self.blocks = [
            Block(GOLAY_BITS, GOLAY_RADIUS, 11, _golay_syndrome, excess),
            Block(HAMMING_BITS, HAMMING_RADIUS, 3, _hamming_syndrome, excess),
            Block(PLAIN_BITS, 0, PLAIN_BITS, lambda w: w, 0),
        ]
        plain = self.blocks[2]  # every plain value is an anchor: a flipped bit is excess
        flips = [f for f in range(1 << PLAIN_BITS) if f.bit_count() <= excess]
        plain.cost = np.tile(np.array([f.bit_count() for f in flips], np.uint8), (1 << PLAIN_BITS, 1))
        plain.pattern = np.tile(np.array(flips, np.uint32), (1 << PLAIN_BITS, 1))

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, is_home) for every anchor within reach of ``words`` (uint32)."""
        row = np.arange(len(words))
        anchor, cost = words.copy(), np.zeros(len(words), np.uint8)
        shift = 0
        for block in self.blocks:
            part = (words >> np.uint32(shift)) & np.uint32((1 << block.bits) - 1)
            s = block.syndromes(part) if block.bits != PLAIN_BITS else part.astype(np.int64)
            total = cost[:, None] + block.cost[s[row]]
            keep, j = np.nonzero(total <= self.excess)
            row, cost = row[keep], total[keep, j]
            anchor = anchor[keep] ^ (block.pattern[s[row], j] << np.uint32(shift))
            shift += block.bits
        return row, anchor, cost == 0
