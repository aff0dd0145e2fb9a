"""Main text of web pages: a recurrent labeller over the leaf blocks.

A page becomes a sequence of leaf blocks. Each block has a vector of its hashed
tag path, of its hashed words, and a few measures. A bidirectional LSTM reads
the whole sequence and gives each block the probability of being main text, so
a block is judged in the page's context. The network is small, written in
numpy, and trained here, from pages that ``html_pages`` invents from a seed.

Defined cases: a null or empty page has an empty text; so has one without main
text; broken markup is read as far as it makes sense; equal pages give equal
texts; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candela.llm.common import map_batches
from candela.llm.html_pages import PageMaker
from candela.llm.html_parse import HIDDEN as HIDDEN_PART
from candela.llm.html_parse import Block, blocks, path_of

PATH_DIM, WORD_DIM, MEASURES = 320, 32, 8
INPUT = PATH_DIM + WORD_DIM + MEASURES
HIDDEN = 24
#: Elements whose name says that they hold no main text; the labeller decides on all others. A form that holds
#: most of the page's text is the page's frame, and says nothing.
NEVER = frozenset(("nav", "footer", "aside", "form", "dialog"))
FORM = frozenset(("form",))
PAGES, EPOCHS, BATCH, RATE, SEED = 3_000, 6, 32, 0.01, 42


@lru_cache(200_000)
def place(word: str, dim: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode())
    return h % dim, 1.0 if h >> 16 & 1 else -1.0


@lru_cache(20_000)
def path_places(path: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of a path's names, the innermost ones once more."""
    found = [place(part, PATH_DIM) for part in sorted(set(path))] + [place("\0" + part, PATH_DIM) for part in path[-2:]]
    return np.array([at for at, _ in found], "int64"), np.array([sign for _, sign in found], "float32")


def features(page: list[Block]) -> np.ndarray:
    """One row for each block."""
    out = np.zeros((len(page), INPUT), "float32")
    for k, (row, block) in enumerate(zip(out, page, strict=True)):
        at, signs = path_places(block.path)
        np.add.at(row, at, signs)
        words = block.text.lower().split()
        hashes = np.fromiter((zlib.crc32(w.encode()) for w in words), "int64", len(words))
        signs = np.where(hashes >> 16 & 1, 1.0, -1.0)
        vector = np.bincount(hashes % WORD_DIM, signs, WORD_DIM)
        row[PATH_DIM : PATH_DIM + WORD_DIM] = 0.5 * vector / max(1.0, np.sqrt(len(words)))
        n = len(block.text)
        row[PATH_DIM + WORD_DIM :] = (
            np.log1p(n) / 5,
            np.log1p(len(words)) / 4,
            block.link_chars / n,
            sum(block.text.count(c) for c in ".,;!?") / len(words),
            block.depth / 10,
            k / len(page),
            k < 2,
            block.text[-1] in ".!?:",
        )
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Direction:
    """Weights of one direction; gates in the order input, forget, output, candidate."""

    w: np.ndarray  # [INPUT, 4 HIDDEN]
    u: np.ndarray  # [HIDDEN, 4 HIDDEN]
    b: np.ndarray

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Hidden states [time, page, HIDDEN] for inputs [time, page, INPUT]; masked steps leave the state as it is."""
        given = x @ self.w + self.b
        steps, n = mask.shape
        h, c = np.zeros((n, HIDDEN), "float32"), np.zeros((n, HIDDEN), "float32")
        out = np.empty((steps, n, HIDDEN), "float32")
        trace = []
        for t in range(steps):
            z = given[t] + h @ self.u
            gates = sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = np.where(m, f * c + i * g, c)
            tanh_c = np.tanh(new_c)
            new_h = np.where(m, o * tanh_c, h)
            if keep:
                trace.append((h, c, i, f, o, g, tanh_c, m))
            h, c = new_h, new_c
            out[t] = h
        return (out, trace) if keep else out

    def gradients(self, x: np.ndarray, trace: list, d_out: np.ndarray):
        d_w, d_u, d_b = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        d_h = d_c = np.zeros_like(d_out[0])
        d_z = np.empty((*d_out.shape[:2], 4 * HIDDEN), "float32")
        for t in range(len(trace) - 1, -1, -1):
            h, c, i, f, o, g, tanh_c, m = trace[t]
            d_h = d_h + d_out[t]
            into = np.where(m, d_h, 0)
            d_c_in = d_c * m + into * o * (1 - tanh_c**2)
            d_z[t] = np.concatenate(
                [d_c_in * g * i * (1 - i), d_c_in * c * f * (1 - f), into * tanh_c * o * (1 - o), d_c_in * i * (1 - g**2)], axis=1
            )
            d_u += h.T @ d_z[t]
            d_c = np.where(m, d_c_in * f, d_c)
            d_h = np.where(m, 0, d_h) + d_z[t] @ self.u.T
        flat = d_z.reshape(-1, 4 * HIDDEN)
        return x.reshape(-1, INPUT).T @ flat, d_u, flat.sum(axis=0) + d_b


@dataclass
class Labeller:
    forward: Direction
    backward: Direction
    v: np.ndarray  # [2 HIDDEN]
    bias: np.ndarray

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of main text, for each block of each page; pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = [k for k in sorted(range(len(pages)), key=lambda k: len(pages[k])) if len(pages[k])]
        at = 0
        while at < len(order):
            # pages of a group fill a bounded number of cells
            stop = at + 1
            while stop < len(order) and stop - at < 128 and (stop + 1 - at) * len(pages[order[stop]]) < 20_000:
                stop += 1
            group = [pages[k] for k in order[at:stop]]
            x, mask = packed(group)
            hidden = self.hidden(x, mask)
            p = sigmoid(hidden @ self.v + self.bias)
            for column, k in enumerate(order[at:stop]):
                out[k] = p[: len(pages[k]), column]
            at = stop
        return out

    def hidden(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward.run(x, mask), self.backward.run(x[::-1], mask[::-1])[::-1]], axis=2)

    def main_text(self, pages: list[str | None]) -> list[str]:
        parsed = [unframed(blocks(p)) for p in pages]
        found = self.probabilities([features(b) for b in parsed])
        return [
            "\n".join(b.text for b, p in zip(page, ps, strict=True) if p > 0.5 and HIDDEN_PART not in b.path and not b.inside(NEVER))
            for page, ps in zip(parsed, found, strict=True)
        ]


def unframed(page: list[Block]) -> list[Block]:
    """The blocks, without forms in their paths where forms hold most of the page's text."""
    inside = sum(len(b.text) for b in page if b.inside(FORM))
    if 2 * inside <= sum(len(b.text) for b in page):
        return page
    out = []
    for b in page:
        levels = tuple(x for x in b.levels if x[0] not in FORM)
        out.append(Block(b.text, levels, b.link_chars, path_of(levels)))
    return out


def packed(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Inputs [time, page, INPUT] and whether a step is a block."""
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), INPUT), "float32")
    mask = np.zeros((longest, len(pages)), bool)
    for k, page in enumerate(pages):
        x[: len(page), k] = page
        mask[: len(page), k] = True
    return x, mask


def labelled_page(marked: str) -> tuple[list[Block], np.ndarray]:
    """Blocks of a page in which main text stands between marks, and their labels."""
    page = blocks(marked.replace("\x01", "<!---->").replace("\x02", "<!---->"))
    # the same parse, with every character of main text marked
    coloured, inside, in_tag = [], False, False
    for c in marked:
        if c in "\x01\x02":
            inside = c == "\x01"
            coloured.append("<!---->")
            continue
        in_tag = c == "<" or in_tag and c != ">"
        coloured.append("\x03" if inside and not in_tag and c not in "<> \n&;" else c)
    labels = [b.text.count("\x03") * 2 > len(b.text.replace(" ", "")) for b in blocks("".join(coloured))]
    return page, np.array(labels, "float32")


@lru_cache(1)
def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """A labeller trained by back-propagation through time, with Adam; the same on every call."""
    maker, data = PageMaker(seed), []
    while len(data) < pages:
        page, labels = labelled_page(maker.page())
        if 0 < len(page) == len(labels):
            data.append((features(unframed(page)), labels))
    rng = np.random.default_rng(seed)
    new = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("float32")
    start = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype("float32")
    sides = [Direction(new(INPUT, 4 * HIDDEN) * 0.5, new(HIDDEN, 4 * HIDDEN), start.copy()) for _ in range(2)]
    model = Labeller(*sides, new(2 * HIDDEN, 1)[:, 0], np.zeros(1, "float32"))
    weights = [sides[0].w, sides[0].u, sides[0].b, sides[1].w, sides[1].u, sides[1].b, model.v, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, total = 0, epochs * (len(data) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(data) - BATCH + 1, BATCH):
            chosen = [data[k] for k in order[at : at + BATCH]]
            x, mask = packed([f for f, _ in chosen])
            y = np.zeros(mask.shape, "float32")
            for k, (_, labels) in enumerate(chosen):
                y[: len(labels), k] = labels
            ahead, trace = sides[0].run(x, mask, keep=True)
            back, trace_back = sides[1].run(x[::-1], mask[::-1], keep=True)
            hidden = np.concatenate([ahead, back[::-1]], axis=2)
            error = (sigmoid(hidden @ model.v + model.bias) - y) * mask / mask.sum()
            d_hidden = error[:, :, None] * model.v
            grads = [
                *sides[0].gradients(x, trace, np.ascontiguousarray(d_hidden[:, :, :HIDDEN])),
                *sides[1].gradients(x[::-1], trace_back, np.ascontiguousarray(d_hidden[::-1, :, HIDDEN:])),
                np.einsum("tb,tbh->h", error, hidden),
                error.sum(keepdims=True).reshape(1),
            ]
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, g in enumerate(grads):
                g = g * min(1.0, 1 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype("float32")
    return model


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    shared = pages.sparkSession.sparkContext.broadcast(train())
    rows = pages.select("page_id", "url", "html")
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = shared.value.main_text(batch.column(2).to_pylist())
        arrays = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_batches(rows, schema, work)
