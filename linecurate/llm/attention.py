"""A small causal self-attention language model in numpy: forward, backward, training, scoring.

Texts are rows of numbers 0..size-1; number size stands before and in front of a text. A window
holds 2 * STEP inputs and predicts what follows the last STEP of them; windows overlap by STEP,
so each item is scored exactly once, with STEP to 2 * STEP - 1 items of context (fewer at the
start of a text). Items are predicted in two levels, a class and a place in it.
"""

from __future__ import annotations

import numpy as np

STEP = 16
KEY = 16
WIDTH = 32
PLACES = 32  # items of a class
RUN = 8  # windows that training takes one after another
RUNS = 32  # such runs in a batch
_CLOSED = np.float32(-1e4)
_MOST = np.float32(60)  # above this a score counts as this, so that its exponential is finite
_MANY = 32
_TABLES = ("query", "key", "value", "self")
_LAG = np.arange(STEP)[:, None] + STEP - np.arange(2 * STEP)[None, :]  # how far a key lies before a query


class Model:
    """Parameters by name; items are in order of frequency, so classes are bands of frequency."""

    names = ("query", "key", "value", "self", "lag", "wc", "bc", "wp", "bp")

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.size = parts["wp"].shape[0] * PLACES

    @classmethod
    def fresh(cls, counts: np.ndarray, seed: int = 3) -> Model:
        """counts: of each item in the sample; the start predicts just these."""
        classes = -(-len(counts) // PLACES)
        rng = np.random.default_rng(seed)
        n = classes * PLACES
        share = np.full(n, 0.01)
        share[: len(counts)] += counts
        share = share.reshape(classes, PLACES)
        make = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls({
            "query": make(n + 1, KEY, scale=0.3), "key": make(n + 1, KEY, scale=0.3), "value": make(n + 1, WIDTH, scale=0.3), "self": make(n + 1, WIDTH, scale=0.3),
            "lag": (-0.2 * np.arange(2 * STEP)).astype(np.float32),
            "wc": make(WIDTH, classes, scale=0.05), "bc": np.log(share.sum(axis=1) / share.sum()).astype(np.float32),
            "wp": make(classes, WIDTH, PLACES, scale=0.05), "bp": np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32),
        })

    def to_bytes(self) -> bytes:
        return b"".join(self.parts[k].astype(np.float32).tobytes() for k in self.names)

    @classmethod
    def from_bytes(cls, raw: bytes, like: Model) -> Model:
        flat, at, parts = np.frombuffer(raw, np.float32), 0, {}
        for k in cls.names:
            shape = like.parts[k].shape
            parts[k] = flat[at : at + int(np.prod(shape))].reshape(shape).copy()
            at += int(np.prod(shape))
        return cls(parts)


def windows(texts: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, texts' numbers) of all windows; targets are -1 past a text's end."""
    many = np.array([-(-len(t) // STEP) for t in texts], np.int64)
    total = int(many.sum())
    inputs, targets = np.full((total, 2 * STEP), start, np.int32), np.full((total, STEP), -1, np.int32)
    offset = np.concatenate(([0], np.cumsum(many)))
    flat = np.full(total * STEP, -1, np.int32)
    for i, t in enumerate(texts):
        flat[offset[i] * STEP : offset[i] * STEP + len(t)] = t
    targets[:] = flat.reshape(total, STEP)
    shifted = np.concatenate((np.full(1, start, np.int32), flat[:-1])).reshape(total, STEP)
    first = offset[:-1][many > 0]
    shifted[first, 0] = start
    inputs[:, STEP:] = np.where(shifted < 0, start, shifted)
    inputs[1:, :STEP] = inputs[:-1, STEP:]
    inputs[first, :STEP] = start + 1  # nothing
    return inputs, targets, np.repeat(np.arange(len(texts)), many)


def _lags(model: Model) -> np.ndarray:
    """What a key's place adds to its score, by query and key; closed for keys after the query."""
    bias = model.parts["lag"][np.clip(_LAG, 0, 2 * STEP - 1)]
    return np.where(_LAG >= 0, bias, _CLOSED)


def _both(parts: dict[str, np.ndarray]) -> np.ndarray:
    """For each class the columns of all classes, then of its own places, so that one product gives both; the last row are the biases."""
    classes = parts["wc"].shape[1]
    out = np.empty((classes, WIDTH + 1, classes + PLACES), np.float32)
    out[:, :WIDTH, :classes], out[:, WIDTH, :classes] = parts["wc"], parts["bc"]
    out[:, :WIDTH, classes:], out[:, WIDTH, classes:] = parts["wp"], parts["bp"]
    return out


def _by_class(flat: np.ndarray, classes: int) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """Where the targets lie in order of class (those of -1 left out), where each class begins, and the two columns of each target in _both."""
    kind = flat // PLACES
    order = np.argsort(kind.astype(np.int16), kind="stable")
    order = order[np.searchsorted(kind[order], 0) :]
    kind = kind[order]
    return order, np.searchsorted(kind, np.arange(classes + 1)).tolist(), kind, classes + flat[order] - kind * PLACES


class Scorer:
    """A model's tables laid out for scoring.

    With one layer a query and a key depend on their items only, so exp(query . key) is a table,
    and the lag's part a factor; an empty place has the factor 0. Values have one more number, 1:
    its mix is the sum of the weights, and after division the 1 that the output's biases take.
    """

    def __init__(self, model: Model):
        p, n = model.parts, model.size
        self.places = n + 2
        dots = np.minimum(p["query"] @ p["key"].T * np.float32(KEY**-0.5), 60)
        self.weights = np.concatenate((np.exp(dots), np.zeros((n + 1, 1), np.float32)), axis=1).ravel()
        self.lag = np.exp(_lags(model))
        self.values = np.concatenate((np.concatenate((p["value"], np.ones((n + 1, 1), np.float32)), axis=1), np.zeros((1, WIDTH + 1), np.float32)))
        self.own = np.concatenate((p["self"], np.zeros((n + 1, 1), np.float32)), axis=1)
        self.both, self.classes = _both(p), p["wc"].shape[1]
        self.halves = np.repeat(np.eye(2, dtype=np.float32), (self.classes, PLACES), axis=0)

    def __call__(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target (0 where there is none)."""
        last = inputs[:, STEP:]
        weights = np.take(self.weights, (last * np.int32(self.places))[:, :, None] + inputs[:, None, :])
        weights *= self.lag
        mixed = (weights @ np.take(self.values, inputs, axis=0)).reshape(-1, WIDTH + 1)
        flat = targets.ravel()
        order, edge, kind, place = _by_class(flat, self.classes)
        h = np.take(mixed, order, axis=0)
        h /= h[:, WIDTH:].copy()
        h += np.take(self.own, last.ravel()[order], axis=0)
        np.maximum(h, 0, out=h)
        z = np.empty((len(order), self.classes + PLACES), np.float32)
        for c, (a, b) in enumerate(zip(edge, edge[1:])):
            if a < b:
                np.matmul(h[a:b], self.both[c], out=z[a:b])
        rows = np.arange(len(order))
        got = z[rows, kind] + z[rows, place]
        if z.size and z.max() > _MOST:
            for part in (z[:, : self.classes], z[:, self.classes :]):
                top = part.max(axis=1)
                part -= top[:, None]
                got -= top
        got -= np.log(np.exp(z, out=z) @ self.halves).sum(axis=1)
        out = np.zeros(len(flat), np.float32)
        out[order] = got
        return out.reshape(targets.shape)


def log_probs(model: Model, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    return Scorer(model)(inputs, targets)


def _gradients(parts: dict[str, np.ndarray], lags: np.ndarray, ids: np.ndarray, opens: np.ndarray, targets: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradients of the summed negative log probability of targets, divided by their number; and that mean.

    ids (runs, 1 + windows, STEP) are the inputs of windows that follow each other, with those in
    front of the first; opens marks windows without inputs in front. parts has the item tables
    side by side, as "table": query, key, value, self.
    """
    table, n = parts["table"], targets.shape[0] * targets.shape[1] * STEP
    scale = np.float32(KEY**-0.5)
    x = np.take(table, ids, axis=0)
    # a window's keys and values are its own block and the one before, which lie side by side
    pairs = np.lib.stride_tricks.as_strided(x, (*targets.shape[:2], 2 * STEP, x.shape[3]), x.strides, writeable=False)
    q, k, v = x[:, 1:, :, :KEY] * scale, pairs[..., KEY : 2 * KEY], pairs[..., 2 * KEY : 2 * KEY + WIDTH]
    w = q @ k.swapaxes(2, 3)
    w += lags
    _exp(w)
    w[opens, :, :STEP] = 0
    total = w @ np.ones((2 * STEP, 1), np.float32)
    mixed = w @ v
    mixed /= total
    h = (mixed + x[:, 1:, :, 2 * KEY + WIDTH :]).reshape(n, WIDTH)
    classes, both = parts["wc"].shape[1], _both(parts)
    order, edge, kind, place = _by_class(targets.ravel(), classes)
    real = max(1, len(order))
    o = np.ones((len(order), WIDTH + 1), np.float32)
    np.maximum(np.take(h, order, axis=0), 0, out=o[:, :WIDTH])
    parted = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(edge, edge[1:])) if a < b]
    z = np.empty((len(order), classes + PLACES), np.float32)
    for c, rows in parted:
        np.matmul(o[rows], both[c], out=z[rows])
    _exp(z)
    z[:, :classes] /= z[:, :classes] @ np.ones((classes, 1), np.float32)
    z[:, classes:] /= z[:, classes:] @ np.ones((PLACES, 1), np.float32)
    rows = np.arange(len(order))
    loss = -(np.log(z[rows, kind]) + np.log(z[rows, place])).sum(dtype=np.float64)
    z[rows, kind] -= 1
    z[rows, place] -= 1
    back, do = np.zeros_like(both), np.empty((len(order), WIDTH), np.float32)
    for c, rows in parted:
        np.matmul(o[rows].T, z[rows], out=back[c])
        np.matmul(z[rows], both[c, :WIDTH].T, out=do[rows])
    shared = back[:, :, :classes].sum(axis=0)
    g = {"wc": shared[:WIDTH], "bc": shared[WIDTH], "wp": back[:, :WIDTH, classes:].copy(), "bp": back[:, WIDTH, classes:].copy()}
    do *= o[:, :WIDTH] > 0
    dx = np.empty_like(x)
    dx[:, :1] = 0
    dh = np.zeros((n, WIDTH), np.float32)
    dh[order] = do
    dh = dh.reshape(mixed.shape)
    dx[:, 1:, :, 2 * KEY + WIDTH :] = dh
    dh = dh / total
    d = w.swapaxes(2, 3) @ dh
    dx[:, 1:, :, 2 * KEY : 2 * KEY + WIDTH] = d[:, :, STEP:]
    dx[:, :-1, :, 2 * KEY : 2 * KEY + WIDTH] += d[:, :, :STEP]
    ds = dh @ v.swapaxes(2, 3)
    ds -= (dh * mixed) @ np.ones((WIDTH, 1), np.float32)
    ds *= w
    d = ds.swapaxes(2, 3) @ q
    dx[:, 1:, :, KEY : 2 * KEY] = d[:, :, STEP:]
    dx[:, :-1, :, KEY : 2 * KEY] += d[:, :, :STEP]
    d = ds @ k
    np.multiply(d, scale, out=dx[:, 1:, :, :KEY])
    dlag = (np.ones(n // STEP, np.float32) @ ds.reshape(n // STEP, 2 * STEP * STEP)).reshape(STEP, 2 * STEP)
    g["lag"] = np.bincount(np.clip(_LAG, 0, None).ravel(), weights=np.where(_LAG >= 0, dlag, 0).ravel(), minlength=2 * STEP)[: 2 * STEP].astype(np.float32)
    g["table"] = _sums(ids.ravel(), dx.reshape(-1, table.shape[1]), len(table))
    for d in g.values():
        d /= np.float32(real)
    return g, float(loss) / real


def _exp(z: np.ndarray) -> None:
    """In place; looking for large values costs less than a pass that caps them."""
    if z.size and z.max() > _MOST:
        np.minimum(z, _MOST, out=z)
    np.exp(z, out=z)


def _sums(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each place 0..size-1. Places with many rows are added up one by one, whole rows
    at a time; reduceat, which goes down column by column, is left with the others."""
    count, out = np.bincount(places, minlength=size), np.zeros((size, rows.shape[1]), np.float32)
    order = np.argsort(places.astype(np.int16) if size < 1 << 15 else places, kind="stable")  # short numbers are sorted by radix
    crowded = count >= _MANY
    inside = np.repeat(crowded, count)
    many, few = np.flatnonzero(crowded), np.flatnonzero((count > 0) & ~crowded)
    part, edge = np.take(rows, order[inside], axis=0), [0, *np.cumsum(count[many]).tolist()]
    for i, a, b in zip(many.tolist(), edge, edge[1:]):
        np.add.reduce(part[a:b], axis=0, out=out[i])
    if len(few):
        out[few] = np.add.reduceat(np.take(rows, order[~inside], axis=0), np.cumsum(count[few]) - count[few], axis=0)
    return out


def _joined(model: Model) -> dict[str, np.ndarray]:
    """Copies of the parts, the item tables side by side."""
    rest = {k: model.parts[k].copy() for k in ("lag", "wc", "bc", "wp", "bp")}
    return {"table": np.concatenate([model.parts[k] for k in _TABLES], axis=1), **rest}


def _parted(parts: dict[str, np.ndarray]) -> Model:
    tables = np.split(parts["table"], (KEY, 2 * KEY, 2 * KEY + WIDTH), axis=1)
    return Model({**{k: v for k, v in parts.items() if k != "table"}, **dict(zip(_TABLES, tables))})


def gradients(model: Model, inputs: np.ndarray, targets: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradients of the mean negative log probability of any windows, and that mean."""
    ids = np.minimum(inputs, model.size).reshape(-1, 2, STEP)
    g, loss = _gradients(_joined(model), _lags(model), ids, (inputs[:, 0] > model.size)[:, None], targets[:, None])
    return _parted(g).parts, loss


def train(model: Model, inputs: np.ndarray, targets: np.ndarray, passes: float, rate: float, seed: int = 5) -> Model:
    """Adam over random batches of RUNS runs of RUN windows; the rate falls to a tenth of its start.

    Each pass sees every window once. Windows are in the order in which windows() gives them.
    """
    rng = np.random.default_rng(seed)
    count = len(inputs)
    runs = -(-count // RUN)
    now = np.full((runs * RUN, STEP), model.size, np.int32)
    now[:count] = inputs[:, STEP:]
    front = np.concatenate((now[:1], now[RUN - 1 : -1 : RUN])).reshape(runs, 1, STEP)
    ids = np.concatenate((front, now.reshape(runs, RUN, STEP)), axis=1)
    opens, wanted = np.ones(runs * RUN, bool), np.full((runs * RUN, STEP), -1, np.int32)
    opens[:count], wanted[:count] = inputs[:, 0] > model.size, targets
    opens, wanted = opens.reshape(runs, RUN), wanted.reshape(runs, RUN, STEP)
    parts = _joined(model)
    m1, m2 = {k: np.zeros_like(v) for k, v in parts.items()}, {k: np.zeros_like(v) for k, v in parts.items()}
    batches = -(-runs // RUNS)
    steps = max(1, round(passes * batches))
    picks: list[np.ndarray] = []
    for t in range(1, steps + 1):
        if not picks:
            picks = np.array_split(rng.permutation(runs), batches)
        pick = picks.pop()
        g, _ = _gradients(parts, _lags(Model({"lag": parts["lag"], "wp": parts["wp"]})), ids[pick], opens[pick], wanted[pick])
        step = np.float32(rate * (1 - 0.9 * t / steps) / (1 - 0.9**t))
        late = np.float32(1 / (1 - 0.99**t))
        for k, d in g.items():
            m1[k] += (d - m1[k]) * np.float32(0.1)
            np.square(d, out=d)
            m2[k] += (d - m2[k]) * np.float32(0.01)
            np.sqrt(m2[k] * late, out=d)
            d += np.float32(1e-8)
            parts[k] -= step * m1[k] / d
    return _parted(parts)
