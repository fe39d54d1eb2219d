"""A gated recurrent unit in numpy: forward over time, and backpropagation through time.

Inputs are symbol numbers; a table gives each symbol's part of the three gates, so a step is a
lookup, one small product and element-wise work over a whole batch:

    z = s(x_z + h U_z)    r = s(x_r + h U_r)    n = tanh(x_n + r * (h U_n))    h' = n + z * (h - n)
"""

from __future__ import annotations

import numpy as np


def new_cell(rng: np.random.Generator, symbols: int, width: int) -> dict[str, np.ndarray]:
    return {
        "table": rng.normal(0, 0.1, (symbols, 3 * width)).astype(np.float32),
        "u": (rng.normal(0, 1, (width, 3 * width)) / np.sqrt(width)).astype(np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def run(cell: dict, symbols: np.ndarray, state: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States (time, batch, width) after each step of ``symbols`` (time, batch); with ``keep``, also what ``back`` needs."""
    width = state.shape[1]
    table, u = cell["table"], cell["u"]
    out = np.empty((*symbols.shape, width), np.float32)
    kept = []
    for t, symbol in enumerate(symbols):
        x, product = table[symbol], state @ u
        gates = product[:, : 2 * width] + x[:, : 2 * width]
        _sigmoid(gates)
        z, r, inner = gates[:, :width], gates[:, width:], product[:, 2 * width :]
        n = r * inner
        n += x[:, 2 * width :]
        np.tanh(n, out=n)
        if keep:
            kept.append((state, z, r, inner, n))
        new = np.subtract(state, n, out=out[t])
        new *= z
        new += n
        state = new
    return out, kept


def back(cell: dict, symbols: np.ndarray, kept: list, d_out: np.ndarray, rows: bool = False) -> dict:
    """Gradients of table and u for gradients ``d_out`` of all states; truncated at the first step.

    With ``rows`` that of the table is a pair: the rows met, and their gradients.
    """
    u = cell["u"]
    width = d_out.shape[2]
    d_state = np.zeros_like(kept[0][0])
    d_u = np.zeros_like(u)
    d_gates = np.empty((*symbols.shape, u.shape[1]), np.float32)
    product = np.empty((symbols.shape[1], u.shape[1]), np.result_type(u, d_out))
    for t in range(len(symbols) - 1, -1, -1):
        state, z, r, inner, n = kept[t]
        d = d_out[t] + d_state
        open_ = 1 - z
        d_n = d * open_
        d_n *= 1 - n * n
        d_z = d * (state - n)
        d_z *= z
        np.multiply(d_z, open_, out=product[:, :width])
        d_inner = np.multiply(d_n, r, out=product[:, 2 * width :])
        d_r = d_inner * inner
        np.multiply(d_r, 1 - r, out=product[:, width : 2 * width])
        d_gates[t, :, : 2 * width] = product[:, : 2 * width]
        d_gates[t, :, 2 * width :] = d_n
        d_u += state.T @ product
        d_state = product @ u.T
        d *= z
        d_state += d
    flat = symbols.ravel()
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    met, sums = ordered[first], np.add.reduceat(d_gates.reshape(-1, u.shape[1])[order], first, axis=0)
    if rows:
        return {"table": (met, sums), "u": d_u}
    d_table = np.zeros_like(cell["table"])
    d_table[met] = sums
    return {"table": d_table, "u": d_u}


class Adam:
    """Steps of a size that the first and second moments of each gradient give.

    A gradient given as (rows, values) moves these rows alone, moments included.
    """

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, gradients: dict, limit: float = 1.0, share: float = 1.0) -> None:
        self.t += 1
        norm = share * np.sqrt(sum(float(np.vdot(v, v)) for v in (g[1] if isinstance(g, tuple) else g for g in gradients.values())))
        scale = np.float32(share * min(1.0, limit / (norm + 1e-9)))
        early, late = np.float32(1 - 0.9**self.t), np.float32(1 - 0.99**self.t)
        for k, g in gradients.items():
            at, g = g if isinstance(g, tuple) else (slice(None), g)
            g = g * scale
            first, second = self.first[k][at], self.second[k][at]
            first += np.float32(0.1) * (g - first)
            g *= g
            second += np.float32(0.01) * (g - second)
            if not isinstance(at, slice):
                self.first[k][at], self.second[k][at] = first, second
            np.divide(second, late, out=g)
            np.sqrt(g, out=g)
            g += np.float32(1e-7)
            np.divide(first, g, out=g)
            g *= np.float32(self.rate) / early
            self.params[k][at] -= g
