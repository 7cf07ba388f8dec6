"""Per-element recurrent forecaster: the only Python inside a task.

Spark hands over one element's scaled blocks as a pandas frame and gets the scaled
forecast back. An element has at most (slots of the history) x (KPIs of its type)
rows, so a group stays small whatever the table size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd

OUTPUT = (
    "resId string, itemPara string, kpiId string, stepAhead int, scaledValue double, "
    "yMin double, yMax double, trainLossFirst double, trainLossLast double, testLoss double"
)


def check_config(config: Mapping) -> None:
    if config["bidirectional"]:
        raise ValueError("bidirectional: the output layer takes hidden_size inputs, one direction only")
    if config["nonlinearity"] not in ("tanh", "relu"):
        raise ValueError(f"nonlinearity: {config['nonlinearity']!r}")


def init_params(features: int, config: Mapping, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Uniform in +-1/sqrt(hidden) for every matrix and bias."""
    hidden = config["hidden_size"]
    bound = 1.0 / np.sqrt(hidden)

    def draw(*shape):
        return rng.uniform(-bound, bound, shape)

    params = {}
    for layer in range(config["num_layers"]):
        params[f"wx{layer}"] = draw(features if layer == 0 else hidden, hidden)
        params[f"wh{layer}"] = draw(hidden, hidden)
        if config["bias"]:
            params[f"b{layer}"] = draw(hidden) + draw(hidden)
    params["wo"] = draw(hidden, features)
    params["bo"] = draw(features)
    return params


def forward(params, x, state, config, masks=None):
    """Outputs for x of shape (time, batch, features), the last states, and what backward needs."""
    steps, batch, _ = x.shape
    layers, hidden = config["num_layers"], config["hidden_size"]
    if state is None:
        state = np.zeros((layers, batch, hidden))
    inputs, hs = [], []
    seq = x
    for layer in range(layers):
        if layer and masks is not None:
            seq = seq * masks[layer - 1]
        inputs.append(seq)
        drive = seq @ params[f"wx{layer}"] + params.get(f"b{layer}", 0.0)
        h = state[layer]
        out = np.empty((steps, batch, hidden))
        for t in range(steps):
            z = drive[t] + h @ params[f"wh{layer}"]
            h = np.tanh(z) if config["nonlinearity"] == "tanh" else np.maximum(z, 0.0)
            out[t] = h
        hs.append(out)
        seq = out
    active = np.maximum(seq, 0.0)
    return active @ params["wo"] + params["bo"], np.stack([h[-1] for h in hs]), (inputs, hs, active, state)


def backward(params, cache, grad_out, config, masks=None):
    """Gradients of the loss for every parameter, given the gradient at the outputs."""
    inputs, hs, active, state = cache

    def outer(a, b):
        return a.reshape(-1, a.shape[2]).T @ b.reshape(-1, b.shape[2])

    grads = {
        "wo": outer(active, grad_out),
        "bo": grad_out.sum((0, 1)),
    }
    grad = (grad_out @ params["wo"].T) * (active > 0)
    for layer in reversed(range(config["num_layers"])):
        h = hs[layer]
        local = 1.0 - h * h if config["nonlinearity"] == "tanh" else (h > 0).astype(float)
        dz = np.empty_like(h)
        carry = np.zeros_like(h[0])
        wh_t = params[f"wh{layer}"].T
        for t in range(len(h) - 1, -1, -1):
            dz[t] = (grad[t] + carry) * local[t]
            carry = dz[t] @ wh_t
        before = np.concatenate([state[layer][None], h[:-1]])
        grads[f"wh{layer}"] = outer(before, dz)
        grads[f"wx{layer}"] = outer(inputs[layer], dz)
        if config["bias"]:
            grads[f"b{layer}"] = dz.sum((0, 1))
        grad = dz @ params[f"wx{layer}"].T
        if layer and masks is not None:
            grad = grad * masks[layer - 1]
    return grads


def train(x, y, config, seed):
    """Full-batch Adam on the squared error; the last state starts the next epoch."""
    rng = np.random.default_rng(seed)
    params = init_params(x.shape[2], config, rng)
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    rate, b1, b2, tiny, drop = config["learning_rate"], 0.9, 0.999, 1e-8, config["dropout"]
    state, losses = None, []
    shape = (x.shape[0], x.shape[1], config["hidden_size"])
    for epoch in range(1, config["epochs"] + 1):
        masks = None
        if drop:
            masks = [(rng.random(shape) >= drop) / (1.0 - drop) for _ in range(config["num_layers"] - 1)]
        out, state, cache = forward(params, x, state, config, masks)
        diff = out - y
        losses.append(float(np.mean(diff * diff)))
        grads = backward(params, cache, 2.0 * diff / diff.size, config, masks)
        for k, g in grads.items():
            first[k] = b1 * first[k] + (1 - b1) * g
            second[k] = b2 * second[k] + (1 - b2) * g * g
            params[k] -= rate * (first[k] / (1 - b1**epoch)) / (np.sqrt(second[k] / (1 - b2**epoch)) + tiny)
    return params, losses


def fit_predict(config: Mapping) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Grouped function: trains on an element's training blocks and forecasts one block.

    With ``batch_first`` off, recurrence runs over blocks at equal step. The forecast
    is the output for the last test block, or for the first of the last ``block`` ones
    with ``compat_first_block``.
    """
    check_config(config)
    config = dict(config)
    block = config["block"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["kpiId", "blockId", "step"], kind="stable")
        kpis = pdf["kpiId"].unique()
        shape = (len(kpis), -1, block)
        x = pdf["x"].to_numpy().reshape(shape).transpose(1, 2, 0)
        y = pdf["y"].to_numpy().reshape(shape).transpose(1, 2, 0)
        is_train = (pdf["split"].to_numpy() == "train").reshape(shape)[0, :, 0]

        def oriented(a):
            return a.transpose(1, 0, 2) if config["batch_first"] else a

        seed = zlib.crc32(str(pdf["resId"].iat[0]).encode())
        params, losses = train(oriented(x[is_train]), oriented(y[is_train]), config, seed)
        held, held_y = x[~is_train], y[~is_train]
        fitted = oriented(forward(params, oriented(held), None, config)[0])
        ahead = fitted
        if len(held) > block:
            ahead = oriented(forward(params, oriented(held[-block:]), None, config)[0])
        chosen = ahead[0] if config.get("compat_first_block") else ahead[-1]

        ends = pdf.groupby("kpiId", sort=True)[["yMin", "yMax"]].first().loc[kpis]
        return pd.DataFrame(
            {
                "resId": pdf["resId"].iat[0],
                "itemPara": pdf["itemPara"].iat[0],
                "kpiId": np.repeat(kpis, block),
                "stepAhead": np.tile(np.arange(1, block + 1, dtype="int32"), len(kpis)),
                "scaledValue": chosen.T.reshape(-1),
                "yMin": np.repeat(ends["yMin"].to_numpy(), block),
                "yMax": np.repeat(ends["yMax"].to_numpy(), block),
                "trainLossFirst": losses[0],
                "trainLossLast": losses[-1],
                "testLoss": float(np.mean((fitted - held_y) ** 2)),
            }
        )

    return run
