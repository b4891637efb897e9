"""Leading eigenpairs of a symmetric positive matrix that is only known by its products with a few columns.

Jacobi-Davidson with a block of Ritz vectors: a subspace grows by solutions of the correction equation

    (I - Q Q') (A - theta I) (I - Q Q') t = -r,    Q: locked vectors and the block's Ritz vectors,

each solved by some steps of MINRES from the right-hand side. The systems of the block run side by side, so one product serves all of them. After each growth
Rayleigh-Ritz gives new pairs; a pair whose residual is at rounding level is locked, leading pairs first. A subspace that has become too wide shrinks to its
leading Ritz vectors (thick restart). All arrays here have the matrix's dimension times a few dozen columns.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Residuals count as rounding when they are below so many units in the last place of the matrix's scale, times the root of its dimension.
ULPS = 8
INNER, WIDEST, ROUNDS = 12, 10, 200
Product = Callable[[np.ndarray], np.ndarray]


def orthonormal(x: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what `x` adds to the orthonormal columns of `against`; columns that add nothing but rounding are left out."""
    kept = [against[:, j] for j in range(against.shape[1])]
    for j in range(x.shape[1]):
        v = x[:, j].copy()
        size = np.linalg.norm(v)
        for _ in range(3):
            for q in kept:
                v -= q * (q @ v)
        left = np.linalg.norm(v)
        if left > 1e-12 * size and left > 0:
            v /= left
            for q in kept:
                v -= q * (q @ v)
            kept.append(v / np.linalg.norm(v))
    return np.array(kept[against.shape[1] :]).T.reshape(len(x), -1)


def minres(product: Product, shifts: np.ndarray, right: np.ndarray, basis: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate t of the projected systems, one column each; a system stops when its residual has shrunk by `tolerance` or its Krylov space is used up."""

    def away(x: np.ndarray) -> np.ndarray:
        x = x - basis @ (basis.T @ x)
        return x - basis @ (basis.T @ x)

    n, b = right.shape
    v = away(right)
    beta = np.linalg.norm(v, axis=0)
    start, phi, live = beta.copy(), beta.copy(), beta > 0
    x, v_old, d1, d2 = np.zeros((n, b)), np.zeros((n, b)), np.zeros((n, b)), np.zeros((n, b))
    v = v / np.where(live, beta, 1)
    beta, c1, s1, c2, s2 = np.zeros(b), np.ones(b), np.zeros(b), np.ones(b), np.zeros(b)
    for _ in range(steps):
        if not live.any():
            break
        w = np.zeros((n, b))
        w[:, live] = away(product(v[:, live]) - v[:, live] * shifts[live])
        w -= v_old * beta
        alpha = (v * w).sum(0)
        w -= v * alpha
        after = np.linalg.norm(w, axis=0)
        # two earlier rotations act on the new column of the tridiagonal matrix, the next one clears what is below
        epsilon, delta = s1 * beta, c1 * beta
        rho2, gamma = c2 * delta + s2 * alpha, -s2 * delta + c2 * alpha
        rho1 = np.hypot(gamma, after)
        live &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1)
        c, s = gamma / safe, after / safe
        d = np.where(live, (v - d1 * rho2 - d2 * epsilon) / safe, 0)
        x += d * (c * phi) * live
        phi = np.where(live, -s * phi, phi)
        d2, d1, c1, s1, c2, s2 = d1, d, c2, s2, c, s
        live &= (np.abs(phi) > tolerance * start) & (after > 1e-14 * np.abs(shifts))
        v_old, v, beta = v, np.where(live, w / np.where(after > 0, after, 1), 0), after
    return x


def leading(product: Product, size: int, wanted: int, scale: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the `wanted` largest, fewer if the matrix has fewer rows.

    `scale`: an upper bound of the largest eigenvalue, as the trace. Equal eigenvalues give some orthonormal basis of their space. A residual that can't be brought
    to rounding level is an error. An eigenvector's sign is such that its largest entry is positive."""
    wanted = min(wanted, size)
    block = min(size, wanted + 2)
    tolerance = ULPS * np.finfo(float).eps * np.sqrt(size) * scale
    locked = np.zeros((size, 0))
    q = orthonormal(np.random.default_rng(seed).standard_normal((size, block)), locked)
    aq = product(q)
    values: list[float] = []
    for turn in range(ROUNDS):
        small = q.T @ aq
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        q, aq = q @ y, aq @ y
        leads = min(block, q.shape[1])
        residual = aq[:, :leads] - q[:, :leads] * theta[:leads]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        done = 0
        while done < leads and len(values) + done < wanted and norms[done] <= tolerance:
            done += 1
        if done:
            # products that went through restarts carry their rounding: look at fresh ones before locking
            fresh = product(q[:, :done])
            error = np.linalg.norm(fresh - q[:, :done] * theta[:done], axis=0)
            sure = int(np.argmax(error > 2 * tolerance)) if (error > 2 * tolerance).any() else done
            values += [float(q[:, j] @ fresh[:, j]) for j in range(sure)]
            locked = np.hstack([locked, q[:, :sure]])
            q, aq = q[:, sure:], np.hstack([fresh[:, sure:], aq[:, done:]])
            if len(values) >= wanted:
                break
            block, residual, theta, norms = min(block, size - len(values)), residual[:, sure:], theta[sure:], norms[sure:]
        if q.shape[1] > WIDEST * wanted:
            q, aq = q[:, : 3 * wanted], aq[:, : 3 * wanted]
        few = min(wanted - len(values), residual.shape[1])
        if few:
            inside = np.hstack([locked, q[:, : residual.shape[1]]])
            t = minres(product, theta[:few], -residual[:, :few], inside, INNER, max(0.5 ** (turn + 1), 1e-3))
        else:  # all that was looked at is locked
            t = np.random.default_rng(seed + turn + 1).standard_normal((size, 1))
        new = orthonormal(t, np.hstack([locked, q]))
        if not new.shape[1]:  # nothing left in these directions; a random one may lead on, unless the space is used up
            if locked.shape[1] + q.shape[1] < size:
                new = orthonormal(np.random.default_rng(seed + turn + 1).standard_normal((size, 1)), np.hstack([locked, q]))
            else:
                aq = product(q)
        if new.shape[1]:
            new -= locked @ (locked.T @ new)
            q, aq = np.hstack([q, new]), np.hstack([aq, product(new)])
    else:
        raise ArithmeticError(f"residuals stay above {tolerance:.3g}: {norms}")
    order = np.argsort(values)[::-1]
    vectors = locked[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return np.array(values)[order], vectors
