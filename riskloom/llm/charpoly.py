"""Exact characteristic polynomials of integer matrices, their largest real roots and the matching vectors.

Everything here works on one matrix whose size is the number of dimensions, never on rows of a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb, isqrt

import numpy as np

#: Primes start below this, so that a product of two residues fits a signed 64-bit integer.
BELOW = 1 << 31
#: Bases for which the strong pseudoprime test is exact for all numbers under 3,215,031,751 (a published fact).
BASES = (2, 3, 5, 7)


def is_prime(n: int) -> bool:
    """For odd n over 7 and under 2**31."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in BASES:
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product is over twice ``bound``, and one more as a check."""
    found, product, n = [], 1, BELOW - 1
    while True:
        if is_prime(n):
            found.append(n)
            if product > 2 * bound:
                return found
            product *= n
        n -= 2


def coefficient_bound(trace: int, size: int) -> int:
    """No coefficient of the polynomial of a positive semidefinite matrix is larger in absolute value: the k-th
    elementary symmetric function of non-negative roots is largest when they are equal."""
    return max(comb(size, k) * trace**k // size**k + 1 for k in range(size + 1))


def inverse(values: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Inverses modulo the primes, by Fermat's theorem."""
    out, base, power = np.ones_like(values), values % primes, primes - 2
    while power.any():
        out = np.where(power & 1, out * base % primes, out)
        base, power = base * base % primes, power >> 1
    return out


def residues(matrix: Sequence[Sequence[int]], primes: Sequence[int]) -> np.ndarray:
    """The characteristic polynomial modulo each prime (rows: primes; columns: powers from 0 up).

    All primes are reduced at once: similarity transformations bring the matrix to upper Hessenberg form, whose
    leading blocks' polynomials follow from each other.
    """
    p = np.array(primes, np.int64)
    size = len(matrix)
    h = np.array([[[int(x) % q for x in row] for row in matrix] for q in primes], np.int64).reshape(len(p), size, size)
    each, column = np.arange(len(p)), p[:, None]
    for k in range(size - 2):
        # A row below with an entry in column k becomes row k + 1; rows and columns swap together.
        pivot = k + 1 + (h[:, k + 1 :, k] != 0).argmax(1)
        rows = h[each, pivot].copy()
        h[each, pivot], h[:, k + 1] = h[:, k + 1].copy(), rows
        columns = h[each, :, pivot].copy()
        h[each, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), columns
        # Where the whole column is zero the inverse is taken of zero, is zero, and nothing changes.
        share = h[:, k + 2 :, k] * inverse(h[:, k + 1, k], p)[:, None] % column
        h[:, k + 2 :] = (h[:, k + 2 :] - share[:, :, None] * h[:, k + 1][:, None, :] % p[:, None, None]) % p[:, None, None]
        # A sum of products is reduced term by term, so that it stays within 64 bits.
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * share[:, None, :] % p[:, None, None]).sum(2)) % column
    blocks = [np.zeros((len(p), size + 1), np.int64)]
    blocks[0][:, 0] = 1
    for k in range(size):
        last = blocks[-1]
        new = np.zeros_like(last)
        new[:, 1:] = last[:, :-1]
        new = (new - h[:, k, k][:, None] * last) % column
        chain = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            chain = chain * h[:, i + 1, i] % p
            new = (new - (chain * h[:, i, k] % p)[:, None] * blocks[i]) % column
        blocks.append(new)
    return blocks[-1]


def recombined(rows: np.ndarray, primes: Sequence[int]) -> list[int]:
    """The integers of smallest absolute value with these residues; the last prime only checks them."""
    used = list(primes[:-1])
    product = 1
    for q in used:
        product *= q
    weights = [(product // q) * pow(product // q, -1, q) for q in used]
    out = []
    for column in range(rows.shape[1]):
        value = sum(w * int(r) for w, r in zip(weights, rows[:-1, column])) % product
        value -= product * (value > product // 2)
        if value % primes[-1] != int(rows[-1, column]):
            raise ArithmeticError("the polynomial's coefficients pass the bound on them")
        out.append(value)
    return out


def roots_above(coefficients: Sequence[int], at: int) -> int:
    """How many roots lie above ``at``, multiple ones counted as often: for a polynomial with real roots only, the
    sign changes among the coefficients about that point."""
    shifted = list(coefficients)
    for first in range(len(shifted) - 1):
        for k in range(len(shifted) - 2, first - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_at(coefficients: Sequence[int], at: int) -> int:
    total = 0
    for c in reversed(coefficients):
        total = total * at + c
    return total


#: Roots are found as whole multiples of 2**-FRACTION; equal to this grain, they count as one multiple root.
FRACTION = 96


def largest_roots(coefficients: Sequence[int], most: int, top: int) -> list[tuple[int, int]]:
    """(root times 2**FRACTION rounded down, multiplicity), falling, of the ``most`` largest roots over zero, each
    counted as often as it occurs. ``top`` is a bound on them.

    Intervals are halved until each holds one root (or roots that agree to the grain); a single root is then closed in on by the
    sign of the polynomial alone.
    """
    size = len(coefficients) - 1
    scaled = [c << (FRACTION * (size - k)) for k, c in enumerate(coefficients)]
    high = (top + 1) << FRACTION
    positive = roots_above(scaled, 0)
    found: list[tuple[int, int]] = []
    # (low, high, roots above low, roots above high]; the highest interval is handled first.
    waiting = [(0, high, positive, 0)]
    while waiting and sum(m for _, m in found) < most:
        low, high, above_low, above_high = waiting.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1:
            found.append((single_root(scaled, low, high), 1))
            continue
        if high - low == 1:
            found.append((low, above_low - above_high))
            continue
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        waiting += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def single_root(scaled: Sequence[int], low: int, high: int) -> int:
    """The root in (low, high], rounded down to the grain unless it is ``high`` itself: Newton steps inside a closing bracket."""
    last = value_at(scaled, high)
    if last == 0:
        return high
    slope = [k * c for k, c in enumerate(scaled)][1:]
    guess = (low + high) // 2
    while high - low > 1:
        value = value_at(scaled, guess)
        if value == 0:
            return guess
        if (value > 0) == (last > 0):
            high = guess
        else:
            low = guess
        steep = value_at(slope, guess)
        step = guess - value // steep if steep else low
        # Near the end of the bracket a step may stand still; halving closes it in any case.
        if not low < step < high:
            step = (low + high) // 2
        elif abs(step - guess) <= 2 and high - low > 8:
            # Newton has settled: look a few grains to both sides.
            for edge in (max(low, step - 4), min(high, step + 4)):
                if low < edge < high:
                    v = value_at(scaled, edge)
                    if v == 0:
                        return edge
                    if (v > 0) == (last > 0):
                        high = edge
                    else:
                        low = edge
            step = (low + high) // 2
        guess = step
    return low


#: Bits after the point in the elimination.
PRECISION = 320


def null_vectors(matrix: Sequence[Sequence[int]], root: int, count: int) -> np.ndarray:
    """``count`` orthonormal vectors (rows) that the matrix stretches by root / 2**FRACTION, by inverse iteration.

    The shifted matrix is eliminated once in whole numbers with PRECISION bits behind the point, relative to its
    largest entry; the nearly zero pivots of its null space are replaced by one grain. Two rounds of solving and
    orthogonalising then leave a residual far below double precision.
    """
    size = len(matrix)
    unit = max(1, max(abs(int(x)) for row in matrix for x in row))
    one = 1 << PRECISION
    a = np.empty((size, size), object)
    for i in range(size):
        for j in range(size):
            entry = (int(matrix[i][j]) << FRACTION) - (root if i == j else 0)
            a[i, j] = (entry << (PRECISION - FRACTION)) // unit if PRECISION >= FRACTION else 0
    order = list(range(size))
    for k in range(size):
        pivot = max(range(k, size), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        for i in range(k + 1, size):
            share = (a[i, k] << PRECISION) // a[k, k]
            a[i, k] = share
            if share:
                a[i, k + 1 :] = a[i, k + 1 :] - np.array([(share * x) >> PRECISION for x in a[k, k + 1 :]], object)
    # A fixed start without symmetry: no vector of the null space is orthogonal to all of these by construction.
    rng = np.random.default_rng(size)
    vectors = [[(int(x) << PRECISION) >> 30 for x in rng.integers(-(1 << 30), 1 << 30, size)] for _ in range(count)]
    for _ in range(3):
        solved: list[list[int]] = []
        for v in vectors:
            x = [v[i] for i in order]
            for i in range(size):
                x[i] -= sum(a[i, j] * x[j] for j in range(i)) >> PRECISION
            for i in range(size - 1, -1, -1):
                rest = x[i] - (sum(a[i, j] * x[j] for j in range(i + 1, size)) >> PRECISION)
                x[i] = (rest << PRECISION) // a[i, i]
            largest = max(1, max(abs(t) for t in x))
            x = [(t << PRECISION) // largest for t in x]
            for other in solved:
                inner = sum(s * t for s, t in zip(x, other)) >> PRECISION
                x = [s - ((inner * t) >> PRECISION) for s, t in zip(x, other)]
            length = isqrt(sum(t * t for t in x))
            solved.append([(t << PRECISION) // length for t in x] if length else [one if i == 0 else 0 for i in range(size)])
        vectors = solved
    return np.array([[float(t) / float(one) if abs(t) < 1 << 1000 else 0.0 for t in v] for v in vectors])
