"""Spark's ``xxhash64`` of short ASCII texts in DuckDB SQL, for oracles that must
know a surrogate key of an identifier. Arithmetic is modulo 2^64 in 128 bits."""

from __future__ import annotations

#: The primes of the hash and Spark's seed (fixed values).
_P1, _P2, _P3, _P4, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
_SEED = 42
_M = (1 << 64) - 1


def _u(x: int) -> str:
    return f"{x}::UHUGEINT"


def _mod(x: str) -> str:
    return f"(({x}) & {_u(_M)})"


def _mul(x: str, p: int) -> str:
    return _mod(f"({x}) * {_u(p)}")


def _rot(x: str, r: int) -> str:
    return f"({_mod(f'({x}) * {_u(1 << r)}')} + ({x}) // {_u(1 << (64 - r))})"


def _bytes(text: str, first: str, n: int) -> str:
    return " + ".join(f"ascii(substr({text}, ({first} + {k + 1})::INT, 1))::UHUGEINT * {_u(256**k)}" for k in range(n))


def xxhash64(text: str) -> str:
    """SQL of the signed hash of a text column of at most 31 ASCII characters; null
    for null."""
    n = f"length({text})"
    eight, four, one = _u(0), _u(1 << 64), _u(2 << 64)
    words = f"[{eight} + {_bytes(text, 'j * 8', 8)} for j in range(0, {n} // 8)]"
    half = f"CASE WHEN {n} % 8 >= 4 THEN [{four} + {_bytes(text, f'({n} // 8) * 8', 4)}] ELSE [] END"
    rest = f"[{one} + {_bytes(text, 'j', 1)} for j in range(({n} // 4) * 4, {n})]"
    start = f"[{_mod(f'{_u((_SEED + _P5) & _M)} + {n}::UHUGEINT')}]"
    v = f"(x & {_u(_M)})"
    mixed8 = f"xor(h, {_mul(_rot(_mul(v, _P2), 31), _P1)})"
    mixed4 = f"xor(h, {_mul(v, _P1)})"
    mixed1 = f"xor(h, {_mul(v, _P5)})"
    step = (
        f"CASE WHEN x >= {one} THEN {_mul(_rot(mixed1, 11), _P1)} WHEN x >= {four} THEN {_mod(f'{_mul(_rot(mixed4, 23), _P2)} + {_u(_P3)}')} "
        f"ELSE {_mod(f'{_mul(_rot(mixed8, 27), _P1)} + {_u(_P4)}')} END"
    )
    h = f"list_reduce({start} || {words} || {half} || {rest}, lambda h, x: {step})"
    for shift, prime in ((33, _P2), (29, _P3), (32, None)):
        h = f"list_reduce([{h}, {_u(0)}], lambda h, x: xor(h, h // {_u(1 << shift)}))"
        if prime:
            h = _mul(h, prime)
    return f"list_reduce([{h}::HUGEINT, 0::HUGEINT], lambda h, x: CASE WHEN h >= {1 << 63} THEN h - {1 << 64}::HUGEINT ELSE h END)::BIGINT"
