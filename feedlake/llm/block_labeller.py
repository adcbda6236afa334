"""A bidirectional LSTM in numpy that labels each block of a page, reading all of the page.

A block is read as three things: the sum of vectors of the hashed tags and names on its path, the
mean of vectors of its different hashed words, and a few measures of its text. The label is read from both
directions' outputs there and from the block itself. Vectors and cells are learned together by
back-propagation through both directions, with Adam.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np

from feedlake.llm.html_blocks import Block

#: Hash places and widths of path and word vectors, width of a cell.
PATHS, WORDS, PATH_WIDTH, WORD_WIDTH, CELL = 1_024, 4_096, 16, 8, 16
MEASURES = 8
#: Words that the mean of a block's words has beside them, all zero: one or two words tell little.
FEW = 4
_STOP = re.compile(r"[.!?…。]\W*$")


@dataclass
class Features:
    """Blocks of several pages, one after another."""

    path: np.ndarray  # hashed path entries of all blocks
    path_at: np.ndarray  # where each block's begin
    word: np.ndarray
    word_at: np.ndarray
    measures: np.ndarray
    pages: np.ndarray  # blocks per page


def features(pages: Sequence[Sequence[Block]]) -> Features:
    path, path_at, word, word_at, measures = [], [0], [], [0], []
    for page in pages:
        title = next((b.text for b in page if b.last == "title"), "")[:40]
        last = max(1, len(page) - 1)
        for i, b in enumerate(page):
            path += [crc32(f"{x}".encode()) % PATHS for x in b.path]
            path.append(crc32(f">{b.last}".encode()) % PATHS)
            path_at.append(len(path))
            words = b.text.lower().split()
            word += sorted(crc32(w.encode("utf-8", "replace")) % WORDS for w in set(words))
            word_at.append(len(word))
            n = len(b.text)
            measures.append(
                (
                    min(np.log1p(len(words)) / 4, 2.0),
                    b.linked,
                    min(n / max(1, len(words)) / 10, 2.0),
                    1.0 if _STOP.search(b.text[-8:]) else 0.0,
                    sum(map(b.text.count, "|©»›·•")) / n,
                    i / last,
                    1.0 if title and b.last != "title" and b.text.startswith(title[: len(b.text)]) and len(b.text) >= len(title) / 2 else 0.0,
                    1.0,
                )
            )
    return Features(
        np.array(path, np.int64),
        np.array(path_at),
        np.array(word, np.int64),
        np.array(word_at),
        np.array(measures, np.float32).reshape(-1, MEASURES),
        np.array([len(p) for p in pages], np.int64),
    )


def _sums(table: np.ndarray, index: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(index):
        return np.zeros((len(at) - 1, table.shape[1]), table.dtype)
    out = np.add.reduceat(table[index], np.minimum(at[:-1], len(index) - 1), axis=0)
    out[at[1:] == at[:-1]] = 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _cells(z: np.ndarray, u: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Outputs, gates and states over time of sequences, longest first, from inputs (time, sequence, 4 cells)."""
    steps, n, width = z.shape[0], z.shape[1], u.shape[0]
    out, state = np.zeros((steps + 1, n, width), z.dtype), np.zeros((steps + 1, n, width), z.dtype)
    gates = np.zeros_like(z)
    for t in range(steps):
        live = int(np.searchsorted(-lengths, -t, "left"))  # sequences longer than t
        a = z[t, :live] + out[t - 1, :live] @ u
        a[:, : 3 * width] = _sigmoid(a[:, : 3 * width])
        a[:, 3 * width :] = np.tanh(a[:, 3 * width :])
        i, f, o, g = np.split(a, 4, axis=1)
        state[t, :live] = f * state[t - 1, :live] + i * g
        out[t, :live] = o * np.tanh(state[t, :live])
        gates[t, :live] = a
    return out, gates, state


def _cells_back(d: np.ndarray, u: np.ndarray, out: np.ndarray, gates: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of inputs and of ``u`` from those of the outputs."""
    width = u.shape[0]
    dz, du = np.zeros_like(gates), np.zeros_like(u)
    dh, dc = np.zeros_like(d[0]), np.zeros_like(d[0])
    for t in reversed(range(len(gates))):
        i, f, o, g = np.split(gates[t], 4, axis=1)
        h = d[t] + dh
        c = np.tanh(state[t])
        dc = dc + h * o * (1 - c * c)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * state[t - 1] * f * (1 - f), h * c * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        du += out[t - 1].T @ dz[t]
        dh, dc = dz[t] @ u.T, dc * f
    return dz, du


class Labeller:
    """Parameters by name; ``logits`` reads pages, ``fit`` learns."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        wide = PATH_WIDTH + WORD_WIDTH + MEASURES

        def normal(scale: float, *shape: int) -> np.ndarray:
            return (scale * r.normal(size=shape)).astype(np.float32)

        self.p = {"path": normal(0.3, PATHS, PATH_WIDTH), "word": normal(0.3, WORDS, WORD_WIDTH)}
        for way in "fb":
            bias = np.zeros(4 * CELL, np.float32)
            bias[CELL : 2 * CELL] = 1  # cells remember at first
            self.p |= {f"w{way}": normal(wide**-0.5, wide, 4 * CELL), f"u{way}": normal(CELL**-0.5, CELL, 4 * CELL), f"b{way}": bias}
        self.p |= {"out": normal(0.2, 2 * CELL + wide, 1), "bias": np.zeros(1, np.float32)}

    def _read(self, x: Features) -> np.ndarray:
        words = _sums(self.p["word"], x.word, x.word_at) / (FEW + np.diff(x.word_at))[:, None]
        return np.concatenate([_sums(self.p["path"], x.path, x.path_at), words, x.measures], axis=1)

    @staticmethod
    def _places(pages: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
        """Lengths longest first, the time of each block in both directions, and its sequence."""
        order = np.argsort(-pages, kind="stable")
        column = np.empty(len(pages), np.int64)
        column[order] = np.arange(len(pages))
        at = np.cumsum(pages) - pages
        time = np.arange(pages.sum()) - np.repeat(at, pages)
        return pages[order], {"f": time, "b": np.repeat(pages, pages) - 1 - time}, np.repeat(column, pages)

    def _forward(self, x: Features) -> tuple:
        held = self._read(x).astype(np.float32)
        lengths, times, column = self._places(x.pages)
        shape = (int(lengths[0]) if len(lengths) else 0, len(lengths), 4 * CELL)
        outs, kept = [], {}
        for way in "fb":
            z = np.zeros(shape, np.float32)
            z[times[way], column] = held @ self.p["w" + way] + self.p["b" + way]
            kept[way] = _cells(z, self.p["u" + way], lengths)
            outs.append(kept[way][0][times[way], column])
        both = np.concatenate([*outs, held], axis=1)
        return (both @ self.p["out"])[:, 0] + self.p["bias"][0], held, both, kept, times, column

    def logits(self, x: Features) -> np.ndarray:
        return self._forward(x)[0]

    def _gradients(self, x: Features, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        logit, held, both, kept, times, column = self._forward(x)
        chance = _sigmoid(logit)
        d = ((chance - labels) / len(labels)).astype(np.float32)
        grad = {"out": both.T @ d[:, None], "bias": d.sum(keepdims=True)}
        dboth = d[:, None] @ self.p["out"].T
        dheld = dboth[:, 2 * CELL :].copy()
        for k, way in enumerate("fb"):
            out, gates, state = kept[way]
            dout = np.zeros_like(out[:-1])
            dout[times[way], column] = dboth[:, k * CELL : (k + 1) * CELL]
            dz, grad["u" + way] = _cells_back(dout, self.p["u" + way], out, gates, state)
            flat = dz[times[way], column]
            grad["w" + way], grad["b" + way] = held.T @ flat, flat.sum(axis=0)
            dheld += flat @ self.p["w" + way].T
        for name, index, at, part, share in (
            ("path", x.path, x.path_at, dheld[:, :PATH_WIDTH], None),
            ("word", x.word, x.word_at, dheld[:, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH], (FEW + np.diff(x.word_at))[:, None]),
        ):
            grad[name] = np.zeros_like(self.p[name])
            np.add.at(grad[name], index, np.repeat(part if share is None else part / share, np.diff(at), axis=0))
        loss = -np.mean(np.log(np.clip(np.where(labels > 0, chance, 1 - chance), 1e-9, 1)))
        return float(loss), grad

    def fit(self, pages: Sequence[Sequence[Block]], labels: Sequence[Sequence[bool]], epochs: int = 10, batch: int = 16, rate: float = 0.01, seed: int = 1) -> Labeller:
        r = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        # Pages of like length share a batch, in an order drawn anew each time.
        by_length = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        batches = [by_length[i : i + batch] for i in range(0, len(by_length), batch)]
        ready = [(features([pages[i] for i in b]), np.concatenate([np.array(labels[i], np.float32) for i in b])) for b in batches]
        ready = [x for x in ready if len(x[1])]
        step, total = 0, epochs * len(ready)
        for _ in range(epochs):
            for k in r.permutation(len(ready)):
                x, y = ready[k]
                # Now and then a name or the words of a block are not seen, so that the rest must do.
                keep = r.random(len(x.path)) > 0.03
                said = np.repeat(r.random(len(y)) > 0.4, np.diff(x.word_at))
                at, word_at = (np.concatenate([[0], np.cumsum(k)])[a] for k, a in ((keep, x.path_at), (said, x.word_at)))
                _, grad = self._gradients(Features(x.path[keep], at, x.word[said], word_at, x.measures, x.pages), y)
                size = np.sqrt(sum(float(np.square(g).sum()) for g in grad.values()))
                step += 1
                speed = rate * (1 - 0.9 * step / total)
                for name, g in grad.items():
                    g = g * min(1.0, 1.0 / (size + 1e-9))
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.01 * (g * g - second[name])
                    self.p[name] -= speed * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
        return self
