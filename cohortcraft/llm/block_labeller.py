"""Main text of web pages: a bidirectional LSTM (numpy) labels every block of a page.

Each block is a vector of its tag path (hashed names), its hashed words and its
shape (length, share of link text, place). The network reads a page's blocks
in both directions, so each label rests on the whole document; blocks labelled
as content are joined in page order.

There are no labelled blocks, so the network is fitted on weak labels: on a
bounded draw of pages (``LIMIT``), names of a block's path that mean content or
boilerplate by convention label it. While fitting, these names are exchanged
for others of the same meaning and sometimes hidden, and boilerplate with other
pages' words is put in, so that the network knows conventions that the drawn
pages do not use and falls back on words, shape and neighbours.

Defined cases: null or empty page, or no content block: empty text. A page is
never cut; nothing is dropped but blocks labelled as boilerplate. Repeated
rows give equal texts. An empty table fits nothing and has no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import kernels as K
from cohortcraft.llm.html_blocks import Block, blocks

LIMIT = 400
"""Pages that the fit may use (a documented bound of the sample)."""

PATH_SLOTS, WORD_SLOTS = 1024, 1024
PATH_SIZE, WORD_SIZE, SHAPE_SIZE, HIDDEN = 12, 6, 5, 12
PIECE = 1 << 21
"""Characters of markup that are labelled together."""

# Names by which pages mark their parts.
CONTENT_NAMES = "article main .article .post .entry .content .story .main".split()
BOILERPLATE_NAMES = (
    "nav header footer aside form button dialog menu search .nav .menu .navbar .header .footer .sidebar .aside .ad .ads .advert .advertisement "
    ".sponsored .promo .banner .cookie .cookies .consent .notice .popup .modal .newsletter .subscribe .comment .comments .reply .discussion "
    ".related .share .social .breadcrumb .breadcrumbs .pagination .widget .login .search .copyright .toolbar .masthead .form".split()
)
_CONTENT, _BOILERPLATE = frozenset(CONTENT_NAMES), frozenset(BOILERPLATE_NAMES)


def weak_label(path: tuple[str, ...]) -> int:
    """1: some ancestor means content and none boilerplate."""
    names = set(path)
    return int(bool(names & _CONTENT) and not names & _BOILERPLATE)


def _slot(name: str, slots: int) -> int:
    return zlib.crc32(name.encode()) % slots


_SLOTS: dict[str, int] = {}


def _path_slots(path: tuple[str, ...]) -> list[int]:
    out = []
    for n in path:
        at = _SLOTS.get(n)
        if at is None:
            if len(_SLOTS) > 100_000:
                _SLOTS.clear()
            at = _SLOTS[n] = _slot(n, PATH_SLOTS)
        out.append(at)
    return out


def _bags(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    flat = np.fromiter((v for x in lists for v in x), np.int64, int(sizes.sum()))
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _word_bags(found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = K.buffer(pa.array([b.text for b in found], pa.string()))
    data = K.lower(data)
    start, end, first = K.words(data, offsets, K.ALNUM_BREAK)
    return (K.word_hashes(data, start, end) % K.U64(WORD_SLOTS)).astype(np.int64), first


def _shapes(pages: list[list[Block]]) -> np.ndarray:
    rows = []
    for found in pages:
        n = len(found)
        for k, b in enumerate(found):
            rows.append((np.log1p(len(b.text)) / 5, b.link_chars / max(1, len(b.text)), k / max(1, n), 1 / (k + 1), 1 / (n - k)))
    return np.array(rows, np.float64).reshape(-1, SHAPE_SIZE)


def _mean(table: np.ndarray, flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    sizes = np.diff(first)
    out = np.zeros((len(sizes), table.shape[1]))
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = np.add.reduceat(table[flat], first[full], axis=0) / sizes[full][:, None]
    return out


def initial(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = PATH_SIZE + WORD_SIZE + SHAPE_SIZE
    p = {"path": rng.normal(0, 0.5, (PATH_SLOTS, PATH_SIZE)), "word": rng.normal(0, 0.3, (WORD_SLOTS, WORD_SIZE)), "out": rng.normal(0, 0.3, (2 * HIDDEN,)), "bias": np.zeros(1)}
    for d in "fb":
        p[f"x_{d}"] = rng.normal(0, size**-0.5, (size, 4 * HIDDEN))
        p[f"h_{d}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        p[f"c_{d}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])  # the forget gate starts open
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(p: dict, d: str, x: np.ndarray, live: np.ndarray, trace: list | None = None) -> np.ndarray:
    """x (steps, pages, size), live (steps, pages): states after each step; a page's state rests where it has no block."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    gates_x = x @ p[f"x_{d}"] + p[f"c_{d}"]
    out = np.zeros((steps, n, HIDDEN))
    for t in range(steps):
        g = gates_x[t] + h @ p[f"h_{d}"]
        f, i, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        z = np.tanh(g[:, 3 * HIDDEN :])
        c2 = f * c + i * z
        tc = np.tanh(c2)
        h2 = o * tc
        m = live[t][:, None]
        if trace is not None:
            trace.append((h, c, f, i, o, z, tc, m))
        h, c = np.where(m, h2, h), np.where(m, c2, c)
        out[t] = h
    return out


def _lstm_back(p: dict, g: dict, d: str, x: np.ndarray, trace: list, d_out: np.ndarray) -> np.ndarray:
    dx = np.zeros_like(x)
    dh, dc = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
    for t in range(len(trace) - 1, -1, -1):
        h0, c0, f, i, o, z, tc, m = trace[t]
        dh = dh + d_out[t]
        dh_in, dc_in = np.where(m, dh, 0), np.where(m, dc, 0)
        dct = dc_in + dh_in * o * (1 - tc * tc)
        dg = np.concatenate([dct * c0 * f * (1 - f), dct * z * i * (1 - i), dh_in * tc * o * (1 - o), dct * i * (1 - z * z)], axis=1)
        g[f"x_{d}"] += x[t].T @ dg
        g[f"h_{d}"] += h0.T @ dg
        g[f"c_{d}"] += dg.sum(0)
        dx[t] = dg @ p[f"x_{d}"].T
        dh = np.where(m, dg @ p[f"h_{d}"].T, dh)
        dc = np.where(m, dct * f, dc)
    return dx


class Batch:
    """Pages side by side: vectors padded to the longest page."""

    def __init__(self, pages: list[list[Block]], paths: list[list[int]], hide: np.ndarray | None = None) -> None:
        found = [b for page in pages for b in page]
        sizes = np.array([len(page) for page in pages])
        self.steps, self.n = int(sizes.max(initial=0)), len(pages)
        self.page = np.repeat(np.arange(self.n), sizes)
        self.step = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.back = np.repeat(sizes, sizes) - 1 - self.step
        self.path, self.path_first = _bags(paths)
        self.word, self.word_first = _word_bags(found)
        self.shape = _shapes(pages)
        self.keep = np.ones(len(found)) if hide is None else 1.0 - hide

    def inputs(self, p: dict) -> np.ndarray:
        path = _mean(p["path"], self.path, self.path_first) * self.keep[:, None]
        return np.concatenate([path, _mean(p["word"], self.word, self.word_first), self.shape], axis=1)

    def _spread(self, rows: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((self.steps, self.n, rows.shape[1]))
        live = np.zeros((self.steps, self.n), bool)
        x[step, self.page], live[step, self.page] = rows, True
        return x, live

    def margins(self, p: dict, traces: dict | None = None) -> np.ndarray:
        rows = self.inputs(p)
        out = []
        for d, step in (("f", self.step), ("b", self.back)):
            x, live = self._spread(rows, step)
            trace: list | None = None
            if traces is not None:
                trace = []
                traces[d] = (x, trace)
            out.append(_lstm(p, d, x, live, trace)[step, self.page])
        states = np.concatenate(out, axis=1)
        if traces is not None:
            traces["states"] = states
        return states @ p["out"] + p["bias"][0]

    def gradient(self, p: dict, y: np.ndarray) -> tuple[float, dict]:
        traces: dict = {}
        margin = self.margins(p, traces)
        prob = _sigmoid(margin)
        d_margin = (prob - y) / max(1, len(y))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"] = traces["states"].T @ d_margin
        g["bias"] = np.array([d_margin.sum()])
        d_states = d_margin[:, None] * p["out"]
        d_rows = 0.0
        for k, (d, step) in enumerate((("f", self.step), ("b", self.back))):
            x, trace = traces[d]
            d_out = np.zeros((self.steps, self.n, HIDDEN))
            d_out[step, self.page] = d_states[:, k * HIDDEN : (k + 1) * HIDDEN]
            d_rows = d_rows + _lstm_back(p, g, d, x, trace, d_out)[step, self.page]
        for name, flat, first, part in (("path", self.path, self.path_first, d_rows[:, :PATH_SIZE] * self.keep[:, None]), ("word", self.word, self.word_first, d_rows[:, PATH_SIZE : PATH_SIZE + WORD_SIZE])):
            sizes = np.diff(first)
            np.add.at(g[name], flat, np.repeat(part / np.maximum(1, sizes)[:, None], sizes, axis=0))
        loss = -np.mean(np.log(np.clip(np.where(y > 0, prob, 1 - prob), 1e-12, 1))) if len(y) else 0.0
        return float(loss), g


def _exchanged(page: list[Block], rng: np.random.Generator) -> list[list[int]]:
    """Path slots of a page with names swapped for others of the same meaning (one draw per name and page)."""
    other: dict[str, tuple[str, ...]] = {}
    out = []
    for b in page:
        names: list[str] = []
        for n in b.path:
            if n in _CONTENT or n in _BOILERPLATE:
                if n not in other:
                    pool = CONTENT_NAMES if n in _CONTENT else BOILERPLATE_NAMES
                    chosen = n if rng.random() < 0.25 else pool[rng.integers(len(pool))]
                    other[n] = (("div", "section")[rng.integers(2)], chosen) if chosen[0] == "." and n[0] != "." else (chosen,)
                names.extend(other[n])
            else:
                names.append(n)
        out.append(_path_slots(tuple(names)))
    return out


_INNER = ((), ("p",), ("div",), ("div", "p"), ("ul", "li"), ("section", "p"), ("span",))


def _with_boilerplate(page: list[Block], other: list[Block], rng: np.random.Generator) -> list[Block]:
    """The page with some boilerplate added whose words are those of another page (as in readers' comments)."""
    out = list(page)
    for _ in range(int(rng.integers(0, 4))):
        mark = BOILERPLATE_NAMES[rng.integers(len(BOILERPLATE_NAMES))]
        marked = (("div", "section", "ul", "p")[rng.integers(4)], mark) if mark[0] == "." else (mark,)
        inside = out[rng.integers(len(out))].path[:-1] if rng.random() < 0.3 else ("html", "body")
        block = other[rng.integers(len(other))]
        out.insert(int(rng.integers(len(out) + 1)), Block((*inside, *marked, *_INNER[rng.integers(len(_INNER))]), block.text, block.link_chars))
    return out


def train(pages: list[list[Block]], epochs: int = 12, size: int = 16, step: float = 0.02, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = initial()
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order = np.argsort([len(x) for x in pages], kind="stable")
    groups = [order[i : i + size] for i in range(0, len(order), size)]
    t = 0
    for epoch in range(epochs):
        rate = step * 0.5 ** (epoch // 4)
        for k in rng.permutation(len(groups)):
            chosen = [_with_boilerplate(pages[i], pages[rng.integers(len(pages))], rng) for i in groups[k]]
            labels = [weak_label(b.path) for page in chosen for b in page]
            paths = [x for page in chosen for x in _exchanged(page, rng)]
            hide = (rng.random(len(paths)) < 0.03).astype(float)
            _, g = Batch(chosen, paths, hide).gradient(p, np.array(labels, float))
            t += 1
            for name in p:
                first[name] = 0.9 * first[name] + 0.1 * g[name]
                second[name] = 0.99 * second[name] + 0.01 * g[name] ** 2
                p[name] = p[name] - rate * (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-8)
    return p


def label(p: dict[str, np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """Content flags of every block of every page."""
    out: list[np.ndarray] = [np.zeros(len(x), bool) for x in pages]
    order = [i for i in np.argsort([len(x) for x in pages], kind="stable") if pages[i]]
    begin = 0
    while begin < len(order):  # groups of similar length; padding is bounded by the longest
        stop = min(len(order), begin + max(1, 20_000 // len(pages[order[min(len(order) - 1, begin + 63)]])))
        chosen = order[begin:stop]
        flags = Batch([pages[i] for i in chosen], [_path_slots(b.path) for i in chosen for b in pages[i]]).margins(p) > 0
        at = 0
        for i in chosen:
            out[i] = flags[at : at + len(pages[i])]
            at += len(pages[i])
        begin = stop
    return out


def fit(pages: DataFrame, html_col: str = "html", limit: int = LIMIT) -> dict[str, np.ndarray] | None:
    """Fit on the ``limit`` pages with the smallest hash of their markup (all, when there are fewer)."""
    drawn = pages.where(F.col(html_col).isNotNull()).select(F.xxhash64(html_col).alias("u"), F.octet_length(html_col).alias("n"))
    edge = drawn.orderBy("u").limit(limit).agg(F.max("u")).first()[0]
    if edge is None:
        return None
    sample = pages.where(F.xxhash64(html_col) <= F.lit(edge)).select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("u")).dropDuplicates(["u"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for batch in batches for b in map(blocks, batch.column("html").to_pylist()) if b]
        p = train(read) if read else initial()
        yield pa.RecordBatch.from_arrays([pa.array(list(p)), pa.array([v.astype("<f8").tobytes() for v in p.values()], pa.binary())], names=["name", "value"])

    rows = sample.repartition(1).sortWithinPartitions("u").mapInArrow(run, "name string, value binary").collect()  # one small model
    shapes = {k: v.shape for k, v in initial().items()}
    return {r["name"]: np.frombuffer(bytes(r["value"]), "<f8").reshape(shapes[r["name"]]) for r in rows}


def main_text(pages: DataFrame, model: dict[str, np.ndarray] | None, html_col: str = "html") -> DataFrame:
    """Columns of ``pages`` but the markup, with ``text`` (content blocks, one per line) and ``n_chars``."""
    shared = pages.sparkSession.sparkContext.broadcast(model if model is not None else initial())
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    plain = pages.select(*rest, F.col(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = K.buffer(batch.column("_html"))[1]
            for i, j in K.slices(offsets, PIECE):
                part = batch.slice(i, j - i)
                read = [blocks(x) for x in part.column("_html").to_pylist()]
                texts = ["\n".join(b.text for b, keep in zip(page, flags, strict=True) if keep) for page, flags in zip(read, label(shared.value, read), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"]
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.select(*rest).schema)
    return plain.mapInArrow(run, f"{kept + ', ' if rest else ''}text string, n_chars bigint")
