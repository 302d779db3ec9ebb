"""SHA-256 that can stop anywhere and go on elsewhere: its state is a small value that one task hands to the next."""
from __future__ import annotations

import math
import struct
import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

_WORD = 0xFFFFFFFF
State = tuple[tuple[int, ...], int, bytes]  # eight words, bytes taken, bytes that don't fill a block yet


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


#: The standard's constants: the first 32 bits after the point of square roots of the first 8 primes and of cube roots of the first 64.
_ROOTS = tuple(math.isqrt(p << 64) & _WORD for p in _primes(8))
_ROUNDS = tuple(_cube_root(p << 96) & _WORD for p in _primes(64))
_STEP = 64 * 4_096  # bytes whose schedules are made at once


def _schedules(data: bytes) -> list[list[int]]:
    """The 64 words that each block of 64 bytes gives to the rounds, their constants added; for all blocks at once, as they don't hang on the state."""
    turned = lambda x, n: x >> np.uint32(n) | x << np.uint32(32 - n)
    w = np.empty((64, len(data) // 64), np.uint32)
    w[:16] = np.frombuffer(data, ">u4").reshape(-1, 16).T
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        w[i] = w[i - 16] + (turned(x, 7) ^ turned(x, 18) ^ x >> np.uint32(3)) + w[i - 7] + (turned(y, 17) ^ turned(y, 19) ^ y >> np.uint32(10))
    return (w + np.array(_ROUNDS, np.uint32)[:, None]).T.tolist()


def _mixed(words: tuple[int, ...], data: bytes) -> tuple[int, ...]:
    """The words after all blocks of the data; only the last bits of a sum count, so that few are cut off on the way."""
    for at in range(0, len(data), _STEP):
        for block in _schedules(data[at : at + _STEP]):
            a, b, c, d, e, f, g, h = words
            for x in block:
                y, z = e * 0x100000001, a * 0x100000001  # a word twice: it turns by one shift
                one = h + (y >> 6 ^ y >> 11 ^ y >> 25) + (g ^ e & (f ^ g)) + x
                h, g, f, e, d, c, b, a = g, f, e, d + one & _WORD, c, b, a, one + (z >> 2 ^ z >> 13 ^ z >> 22) + (b ^ (a ^ b) & (b ^ c)) & _WORD
            words = tuple((old + new) & _WORD for old, new in zip(words, (a, b, c, d, e, f, g, h)))
    return words


def _native():
    """`_mixed` by the OpenSSL that Python's own hashlib is bound to, a thousand times as fast; None where it can't be called or answers otherwise."""
    import ctypes

    try:
        import _hashlib

        update = ctypes.CDLL(_hashlib.__file__).SHA256_Update
    except (ImportError, AttributeError, OSError):
        return None
    update.argtypes, update.restype = (ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t), ctypes.c_int

    def mixed(words: tuple[int, ...], data: bytes) -> tuple[int, ...]:
        held = (ctypes.c_uint32 * 64)(*words)  # SHA256_CTX: eight words, then counts and a part of a block, which whole blocks don't need
        if update(held, data, len(data)) != 1:
            raise RuntimeError("SHA256_Update failed")
        return tuple(held[:8])

    probe = bytes(range(128))
    return mixed if mixed(_ROOTS, probe) == _mixed(_ROOTS, probe) else None


def start() -> State:
    return _ROOTS, 0, b""


def taken(state: State, data: bytes) -> State:
    words, n, rest = state
    data = rest + data
    whole = len(data) // 64 * 64
    if whole:
        words = (_native() or _mixed)(words, data[:whole])
    return words, n + len(data) - len(rest), data[whole:]


def hexed(state: State) -> str:
    _, n, rest = state
    pad = b"\x80" + b"\0" * ((55 - n) % 64) + struct.pack(">Q", 8 * n)
    return struct.pack(">8I", *taken(state, pad)[0]).hex()
