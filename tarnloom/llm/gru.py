"""A bidirectional gated recurrent network over bytes, in numpy: forward, backpropagation through time, Adam."""

from __future__ import annotations

import numpy as np

CHUNK = 128  # bytes in a window


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): saturates as tanh does, at the cost of a division."""
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * _squash(x) + 0.5


def _slope(s: np.ndarray) -> np.ndarray:
    """Derivative of _squash where its value is s."""
    return (1 - np.abs(s)) ** 2


class ByteGRU:
    """Per gate (update, reset, candidate) and direction: input table (256, H), recurrent matrix (H, H); bias of the
    candidate's recurrent part; one output layer. Gates and candidate squash by x / (1 + |x|)."""

    def __init__(self, classes: int, hidden: int = 16, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.h, self.k = hidden, classes
        scale = 1 / np.sqrt(hidden)
        self.x = rng.normal(0, 0.3, (3, 2, 256, hidden)).astype(np.float32)
        self.u = rng.uniform(-scale, scale, (3, 2, hidden, hidden)).astype(np.float32)
        self.b = np.zeros((2, 1, hidden), np.float32)
        self.v = rng.uniform(-scale, scale, (2 * hidden, classes)).astype(np.float32)
        self.c = np.zeros(classes, np.float32)

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.x, self.u, self.b, self.v, self.c]

    def states(self, data: np.ndarray, cache: list | None = None) -> np.ndarray:
        """(T, B, 2H) states of windows (B, T); the second half runs from the end."""
        n, steps = data.shape
        h = np.zeros((2, n, self.h), np.float32)
        out = np.empty((steps, n, 2 * self.h), np.float32)
        k = self.h
        for t in range(steps):
            xt = np.stack((self.x[:, 0, data[:, t]], self.x[:, 1, data[:, steps - 1 - t]]), 1)
            g = np.matmul(h, self.u)
            z, r = _gate(xt[:2] + g[:2])
            gn = g[2] + self.b
            cand = _squash(xt[2] + r * gn)
            if cache is not None:
                cache.append((h, z, r, gn, cand))
            h = cand + z * (h - cand)
            out[t, :, :k] = h[0]
            out[steps - 1 - t, :, k:] = h[1]
        return out

    def _by_step(self, data: np.ndarray) -> np.ndarray:
        """(classes, T, B): the probabilities of every position of windows (B, T).

        Both directions and all gates run side by side in buffers that stay in the processor's cache; a state is written
        where the output layer reads it, and classes come first so that their sums run along whole rows.
        """
        n, steps = data.shape
        k = self.h
        rows = np.empty((steps, 2, n), np.intp)
        rows[:, 0] = data.T
        rows[:, 1] = data.T[::-1]
        rows[:, 1] += 256
        base = (512 * np.arange(3))[:, None, None]
        table = np.ascontiguousarray(self.x.reshape(1536, k))
        u, half = self.u.copy(), np.repeat(0.5 * self.b, n, axis=1)  # gates are kept doubled; halves of what they multiply make up for it
        u[2] *= 0.5
        h = np.zeros((2, n, k), np.float32)
        at = np.empty((3, 2, n), np.intp)
        xt, g, d = (np.empty((3, 2, n, k), np.float32) for _ in range(3))
        out = np.empty((2, steps, n, k), np.float32)  # by direction and step: the second runs from the end
        zr, cand, gn, dzr, dc = xt[:2], xt[2], g[2], d[:2], d[2]
        for t in range(steps):
            np.add(base, rows[t], out=at)
            np.take(table, at, axis=0, out=xt, mode="clip")
            np.matmul(h, u, out=g)
            zr += g[:2]
            np.abs(zr, out=dzr)
            dzr += 1
            zr /= dzr
            zr += 1
            gn += half
            gn *= zr[1]
            cand += gn
            np.abs(cand, out=dc)
            dc += 1
            cand /= dc
            np.subtract(h, cand, out=dc)
            dc *= zr[0]
            dc *= 0.5
            h = np.add(dc, cand, out=out[:, t])
        p, back = ((self.v[i * k : (i + 1) * k].T @ out[i].reshape(-1, k).T).reshape(self.k, steps, n) for i in (0, 1))
        p += back[:, ::-1]
        p += self.c[:, None, None]
        np.exp(p, out=p)
        p /= p.sum(0)
        return p

    def positions(self, data: np.ndarray) -> np.ndarray:
        """(T, B, classes): the probabilities of every position of windows (B, T)."""
        return self._by_step(data).transpose(1, 2, 0)

    def probabilities(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(B, classes): the probabilities of every position, summed over those that the mask counts."""
        p = self._by_step(data)
        p *= mask.T.astype(np.float32)
        return p.sum(1).T

    def gradients(self, data: np.ndarray, label: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
        n, steps = data.shape
        k = self.h
        cache: list = []
        s = self.states(data, cache)
        logits = s @ self.v + self.c
        logits -= logits.max(-1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(-1, keepdims=True)
        mask = mask.astype(np.float32).T  # (T, B)
        total = max(1.0, float(mask.sum()))
        loss = -float((np.log(p[:, np.arange(n), label] + 1e-9) * mask).sum()) / total
        d = p
        d[:, np.arange(n), label] -= 1
        d *= (mask / total)[:, :, None]
        gv = np.einsum("tbh,tbk->hk", s, d)
        gc = d.sum((0, 1))
        ds = d @ self.v.T
        gx, gu, gb = np.zeros_like(self.x), np.zeros_like(self.u), np.zeros_like(self.b)
        dh = np.zeros((2, n, k), np.float32)
        dx = np.empty((2, steps, n, 3, k), np.float32)  # by direction and place of the byte
        for t in range(steps - 1, -1, -1):
            h, z, r, gn, cand = cache[t]
            dh = dh + np.stack((ds[t, :, :k], ds[steps - 1 - t, :, k:]))
            dcand = dh * (1 - z) * _slope(cand)
            dz = dh * (h - cand) * 0.5 * _slope(2 * z - 1)
            dr = dcand * gn * 0.5 * _slope(2 * r - 1)
            dgn = dcand * r
            dxt = np.stack((dz, dr, dcand))
            dg = np.stack((dz, dr, dgn))
            gu += np.matmul(h.transpose(0, 2, 1), dg)
            gb += dgn.sum(1, keepdims=True)
            dx[0, t], dx[1, steps - 1 - t] = dxt[:, 0].transpose(1, 0, 2), dxt[:, 1].transpose(1, 0, 2)
            dh = dh * z + np.matmul(dg, self.u.transpose(0, 1, 3, 2)).sum(0)
        byte = data.T.ravel()
        order = np.argsort(byte, kind="stable")
        first = np.flatnonzero(np.diff(byte[order].astype(np.int64), prepend=-1))
        for way in (0, 1):
            rows = dx[way].reshape(steps * n, 3, k)[order]
            gx[:, way, byte[order][first]] = np.add.reduceat(rows, first, axis=0).transpose(1, 0, 2)
        return loss, [gx, gu, gb, gv, gc]

    def train(self, data: np.ndarray, label: np.ndarray, mask: np.ndarray, steps: int = 300, batch: int = 96, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam over balanced random batches; windows (N, T) of bytes with one label each."""
        rng = np.random.default_rng(seed)
        m = [np.zeros_like(p) for p in self.parts]
        w = [np.zeros_like(p) for p in self.parts]
        rows = [np.flatnonzero(label == c) for c in np.unique(label)]
        losses = []
        for i in range(1, steps + 1):
            at = np.concatenate([rng.choice(r, max(1, batch // len(rows))) for r in rows])
            loss, grads = self.gradients(data[at], label[at], mask[at])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            lr = rate * min(1.0, 2.02 - 2 * i / steps)
            for p, g, a, b in zip(self.parts, grads, m, w):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p -= (lr * (a / (1 - 0.9**i)) / (np.sqrt(b / (1 - 0.99**i)) + 1e-5)).astype(np.float32)
            losses.append(loss)
        return losses


def windows(texts: list[bytes], size: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts cut into windows (N, size), the text each belongs to, and the positions that count.

    The last window of a text reaches back over the one before, a text shorter than a window is repeated in it; what a
    window shows twice counts once, so every byte counts exactly once.
    """
    parts: list[bytes] = []
    owner: list[int] = []
    first: list[int] = []  # counted positions: first..last of each window
    last: list[int] = []
    for k, t in enumerate(texts):
        n = len(t)
        if n < size:
            parts.append((t * (size // n + 1))[:size] if n else b" " * size)
            owner.append(k)
            first.append(0)
            last.append(n)
            continue
        whole = n // size
        parts.append(t[: whole * size])
        owner += [k] * whole
        first += [0] * whole
        last += [size] * whole
        if n % size:
            parts.append(t[n - size :])
            owner.append(k)
            first.append(size - n % size)
            last.append(size)
    at = np.arange(size)
    mask = (at >= np.array(first, np.int64)[:, None]) & (at < np.array(last, np.int64)[:, None])
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, size), np.array(owner, np.int64), mask
