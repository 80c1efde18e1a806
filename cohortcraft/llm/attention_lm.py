"""Causal self-attention over subword ids, in numpy.

A text is the sequence END, id_1 .. id_n, END; every id after the first symbol
is predicted from the ``SPAN`` symbols before it:

    x_t = E[id_t];  s_tl = q_t . k_(t-l) / sqrt(D) + b_l  for lags l < SPAN inside the text
    c_t = sum_l softmax_l(s_tl) v_(t-l);  h_t = u / (1 + |u|), u = x_t A + c_t B + a
    P(group) = softmax(h_t G + g);  P(class | group) = softmax(h_t O_group + o_group)
    P(id) = P(group of class) * P(class of id | group) * P(id | class)

P(id | class) are smoothed counts over the whole training corpus; classes group
ids by their neighbours, and groups hold ``MEMBERS`` classes of like neighbours,
so a symbol costs two small softmaxes instead of one over all classes. Long texts run in overlapping blocks: a block repeats
the ``SPAN - 1`` symbols before it as context, and scores only its own, so each
id is scored once.
"""

from __future__ import annotations

import numpy as np

D, SPAN, CLASSES, MEMBERS = 16, 8, 1024, 64
GROUPS = CLASSES // MEMBERS
PROFILE = 48
"""Numbers that describe an id's neighbours."""

BLOCK = 4096
_PARTS = ("E", "Q", "K", "V", "b", "A", "B", "a", "G", "g", "O", "o")


def shapes(vocabulary: int) -> dict[str, tuple[int, ...]]:
    return {"E": (vocabulary, D), "Q": (D, D), "K": (D, D), "V": (D, D), "b": (SPAN,), "A": (D, D), "B": (D, D), "a": (D,),
            "G": (D, GROUPS), "g": (GROUPS,), "O": (GROUPS, D, MEMBERS), "o": (GROUPS, MEMBERS)}


def initial(vocabulary: int, seed: int = 17) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {k: rng.normal(0, 0.5 if k == "E" else D**-0.5, s).astype(np.float32) for k, s in shapes(vocabulary).items()}
    p["b"], p["a"], p["g"], p["o"] = (np.zeros_like(p[k]) for k in "bago")
    return p


def pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in _PARTS]).astype(np.float32)


def unpack(flat: np.ndarray, vocabulary: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes(vocabulary).items():
        n = int(np.prod(s))
        out[k] = flat[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


_LAGS = np.arange(SPAN)[:, None]
BOUND = 4.0
"""Largest size of an output weight, so that no score can overflow: |h| < 1 in ``D`` dimensions."""


def _joined(p: dict) -> np.ndarray:
    """(4 D, D + 1): what x and a 1 are multiplied by to give q / sqrt(D), k, v B and x A + a, in this order."""
    weights = np.concatenate([p["Q"] * p["Q"].dtype.type(D**-0.5), p["K"], p["V"] @ p["B"], p["A"]], axis=1)
    bias = np.zeros((4 * D, 1), weights.dtype)
    bias[3 * D :, 0] = p["a"]
    return np.concatenate([weights.T, bias], axis=1)


_Q, _K, _V, _U = (slice(D * i, D * (i + 1)) for i in range(4))  # rows of the joined product


def _before(rows: np.ndarray, n: int) -> np.ndarray:
    """(D, SPAN, n) view: column t of lag l is symbol t - l; ``rows`` have ``SPAN - 1`` columns more at both ends."""
    across, along = rows.strides
    return np.lib.stride_tricks.as_strided(rows[:, SPAN - 1 :], (D, SPAN, n), (across, -along, along), writeable=False)


def _over_lags(weights: np.ndarray, windows: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """(D, n): ``windows`` weighted and summed over the lags, the even and the odd ones apart, as einsum then runs along n."""
    out = np.einsum("ln,dln->dn", weights[::2], windows[:, ::2], out=out)
    out += np.einsum("ln,dln->dn", weights[1::2], windows[:, 1::2])
    return out


def _after(rows: np.ndarray, n: int) -> np.ndarray:
    """(D, SPAN, n) view: column t of lag l is symbol t + l."""
    across, along = rows.strides
    return np.lib.stride_tricks.as_strided(rows[:, SPAN - 1 :], (D, SPAN, n), (across, along, along), writeable=False)


def _shifted(rows: np.ndarray, n: int) -> np.ndarray:
    """(SPAN, n) view: column t of row l is column t + l of ``rows``, which have ``SPAN - 1`` columns more."""
    across, along = rows.strides
    return np.lib.stride_tricks.as_strided(rows, (SPAN, n), (across + along, along), writeable=False)


def _forward(p: dict, ids: np.ndarray, place: np.ndarray) -> dict:
    """ids: symbols of the block; place: position of each symbol in its text.

    Rows x, 1 are (n, D + 1), the joined product and h, 1 are columns; x and the product have ``SPAN - 1`` empty symbols more at both ends.
    """
    n, inner = len(ids), slice(SPAN - 1, SPAN - 1 + len(ids))
    x1 = np.zeros((n + 2 * SPAN - 2, D + 1), p["E"].dtype)
    x1[inner, :D], x1[inner, D] = p["E"].take(ids, axis=0), 1
    joined = _joined(p)
    y = joined @ x1.T
    k, v = _before(y[_K], n), _before(y[_V], n)
    s = np.einsum("dn,dln->ln", y[_Q, inner], k)
    s += p["b"][:, None]
    early = np.flatnonzero(place < SPAN - 1)
    s[:, early] = np.where(place[early] < _LAGS, -1e9, s[:, early])  # masked: before the text's first symbol
    s -= s.max(axis=0)
    w = np.exp(s, out=s)
    w /= w.sum(axis=0)
    u, h1 = y[_U, inner], np.ones((D + 1, n), y.dtype)
    u += _over_lags(w, v)
    part = np.abs(u)
    part += 1
    np.divide(u, part, out=h1[:D])
    return {"x1": x1, "joined": joined, "y": y, "k": k, "v": v, "w": w, "h1": h1, "inner": inner}


def class_log_probabilities(p: dict, ids: np.ndarray, place: np.ndarray, target: np.ndarray, skip: int) -> np.ndarray:
    """ln P(class of the next symbol) after symbols ``skip``.. of the block."""
    h1 = _forward(p, ids, place)["h1"][:, skip:]
    order, bounds = _by_group(target[skip:])
    h1, target = h1.take(order, axis=1), target[skip:][order]
    logs = np.zeros(len(order), h1.dtype)
    for weights, own, parts in _softmaxes(p, target, bounds):
        _, _, own, total = _softmax(weights, h1, own, parts)
        logs += np.log(own) - np.log(total)
    out = np.empty_like(logs)
    out[order] = logs
    return out


def _softmaxes(p: dict, target: np.ndarray, bounds: list) -> list[tuple[np.ndarray, np.ndarray, list]]:
    """(weights and bias, targets, [(weights' number, range of symbols)]) of the groups' softmax and of the members'."""
    groups, members = np.concatenate([p["G"], p["g"][None]])[None], np.concatenate([p["O"], p["o"][:, None]], axis=1)
    return [(groups, target // MEMBERS, [(0, (0, len(target)))]), (members, target % MEMBERS, bounds)]


def _softmax(weights: np.ndarray, h1: np.ndarray, target: np.ndarray, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(exp of all scores, places of the targets' own in it, those, sums) of the columns of ``h1``, a row each; |h| < 1 bounds the scores, so exp needs no shift."""
    wide = weights.shape[2]
    e = np.empty((h1.shape[1], wide), h1.dtype)
    for m, (a, b) in parts:
        np.matmul(h1[:, a:b].T, weights[m], out=e[a:b])
    np.exp(e, out=e)
    at = np.arange(0, e.size, wide) + target
    return e, at, e.reshape(-1).take(at), e @ np.ones(wide, e.dtype)


def _by_group(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, tuple[int, int]]]]:
    """(order, [(group, its range)]): symbols sorted by the group of the class that follows."""
    group = (target // MEMBERS).astype(np.int16)
    order = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
    return order, [(k, (a, b)) for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if b > a]


def sequences(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, places, next ids, first) of texts given by flat ids: END before and after each."""
    sizes = np.diff(first)
    symbols = np.insert(ids.astype(np.int64), first[:-1], end)
    following = np.insert(ids.astype(np.int64), first[1:], end)
    out = np.concatenate([[0], np.cumsum(sizes + 1)])
    place = np.arange(len(symbols)) - np.repeat(out[:-1], sizes + 1)
    return symbols, place, following, out


def score(p: dict, ids: np.ndarray, first: np.ndarray, end: int, class_of: np.ndarray, log_in_class: np.ndarray) -> np.ndarray:
    """ln P of each text."""
    symbols, place, following, out = sequences(ids, first, end)
    logs = np.empty(len(symbols), np.float64)
    target = class_of[following]
    for begin in range(0, len(symbols), BLOCK):
        stop = min(len(symbols), begin + BLOCK)
        low = max(0, begin - SPAN + 1)
        logs[begin:stop] = class_log_probabilities(p, symbols[low:stop], place[low:stop], target[low:stop], begin - low)
    logs += log_in_class[following]
    return np.add.reduceat(logs, out[:-1]) if len(out) > 1 else np.zeros(0)


def gradient(p: dict, ids: np.ndarray, place: np.ndarray, target: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """(mean loss, gradients, rows of E they belong to) of one block."""
    f = _forward(p, ids, place)
    x1, y, k, v, w, h1, inner = (f[name] for name in ("x1", "y", "k", "v", "w", "h1", "inner"))
    n = len(ids)
    order, bounds = _by_group(target)
    back, loss, of = np.zeros((D, n), y.dtype), 0.0, []
    sorted_h = h1.take(order, axis=1)
    for softmax in _softmaxes(p, target[order], bounds):
        of.append(np.zeros_like(softmax[0]))
        loss += _softmax_error(*softmax, sorted_h, of[-1], back)
    g = {"G": of[0][0, :D], "g": of[0][0, D], "O": of[1][:, :D], "o": of[1][:, D]}
    spot = np.empty_like(order)
    spot[order] = np.arange(n)
    slope = np.abs(h1[:D])
    np.subtract(1, slope, out=slope)
    slope *= slope
    dy = np.zeros_like(y)
    du = dy[_U, inner]
    np.multiply(back.take(spot, axis=1), slope, out=du)
    ds = np.zeros((SPAN, n + 2 * SPAN - 2), y.dtype)
    dw = np.einsum("dn,dln->ln", du, v)
    dw -= np.einsum("ln,ln->n", w, dw)
    np.multiply(w, dw, out=ds[:, :n])
    g["b"] = ds.sum(axis=1)
    _over_lags(ds[:, :n], k, dy[_Q, inner])
    later = np.zeros_like(ds)
    later[:, :n] = w
    _over_lags(_shifted(ds, n), _after(y[_Q], n), dy[_K, inner])
    _over_lags(_shifted(later, n), _after(dy[_U], n), dy[_V, inner])
    both = (dy @ x1).T
    g["Q"], g["K"], g["A"], g["a"] = both[:D, _Q] * y.dtype.type(D**-0.5), both[:D, _K], both[:D, _U], both[D, _U]
    g["V"], g["B"] = both[:D, _V] @ p["B"].T, p["V"].T @ both[:D, _V]
    dx = dy[:, inner].T @ f["joined"][:, :D]
    by_id = np.argsort(ids.astype(np.uint16) if p["E"].shape[0] <= 1 << 16 else ids, kind="stable")
    own = ids[by_id]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    g["E"] = np.add.reduceat(dx.take(by_id, axis=0), starts, axis=0)
    return loss, g, own[starts]


def _softmax_error(weights: np.ndarray, target: np.ndarray, parts: list, h1: np.ndarray, of_weights: np.ndarray, of_h: np.ndarray) -> float:
    """Part of the mean loss of one softmax; fills the gradients of its weights and adds those of h."""
    n = h1.shape[1]
    e, at, own, total = _softmax(weights, h1, target, parts)
    e.reshape(-1)[at] -= total  # what is left, over total and n, is the softmax less the target
    scale = 1 / (total * total.dtype.type(n))
    scaled, back, across = h1 * scale, np.empty((len(e), D), e.dtype), np.ascontiguousarray(weights[:, :-1].transpose(0, 2, 1))
    for m, (a, b) in parts:
        np.matmul(scaled[:, a:b], e[a:b], out=of_weights[m])
        np.matmul(e[a:b], across[m], out=back[a:b])
    of_h += back.T * scale
    return float((np.log(total) - np.log(own)).sum(dtype=np.float64)) / n


def train(p: dict, texts: list[np.ndarray], end: int, class_of: np.ndarray, step: float, size: int = 4096) -> tuple[dict, float]:
    """One pass of adaptive gradient steps over ``texts``; returns the parameters and the mean loss."""
    p = {k: v.copy() for k, v in p.items()}
    squares = {k: np.full(v.shape, 1e-6, np.float32) for k, v in p.items()}
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    symbols, place, following, _ = sequences(np.concatenate(texts), first, end)
    target = class_of[following]
    losses = []
    for begin in range(0, len(symbols), size):
        part = slice(begin, begin + size)
        loss, g, own = gradient(p, symbols[part], np.minimum(place[part], np.arange(len(symbols[part]))), target[part])
        losses.append(loss)
        for k, v in g.items():
            at = own if k == "E" else slice(None)
            squares[k][at] += v * v
            p[k][at] -= step * v / np.sqrt(squares[k][at])
        for k in "GgOo":
            np.clip(p[k], -BOUND, BOUND, out=p[k])
    return p, float(np.mean(losses))


def projection(size: int, seed: int = 23) -> np.ndarray:
    """(ids, PROFILE / 2) random vectors of the ids; multiples of 1/1024, so that sums of them are exact in any order."""
    return np.ascontiguousarray(np.round(np.random.default_rng(seed).normal(0, 1, (PROFILE // 2, size)) * 1024).T) / 1024


PAIRS = 1 << 15
"""Distinct neighbours whose vectors are held at a time."""


def add_neighbours(total: np.ndarray, texts: list[np.ndarray], project: np.ndarray) -> None:
    """Add to ``total`` (ids, PROFILE) the vectors of the symbols before and after every occurrence in ``texts``."""
    size, half = project.shape
    if not texts:
        return
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    symbols, _, following, _ = sequences(np.concatenate(texts), first, size - 1)
    for ids, others, columns in ((following, symbols, slice(half)), (symbols, following, slice(half, None))):
        pairs = np.sort((ids * size + others).astype(np.uint32 if size <= 1 << 16 else np.int64))
        at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        counts = np.diff(at, append=len(pairs)).astype(np.float64)
        own, other = np.divmod(pairs[at], pairs.dtype.type(size))
        for begin in range(0, len(own), PAIRS):
            part = slice(begin, begin + PAIRS)
            vectors = project.take(other[part], axis=0)
            vectors *= counts[part, None]
            ends = np.flatnonzero(np.concatenate([[True], own[part][1:] != own[part][:-1]]))
            total[own[part][ends], columns] += np.add.reduceat(vectors, ends, axis=0)


def neighbour_classes(sums: np.ndarray, seen: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of every id from its neighbours' sums and its count: frequent ids alone or by their neighbours (k-means), rare ones in the last class."""
    size = len(seen)
    profile = (sums / np.sqrt(np.maximum(1, seen))[:, None]).astype(np.float32)
    norm = np.linalg.norm(profile, axis=1)
    profile /= np.maximum(norm, 1e-6)[:, None]
    order = np.argsort(-seen, kind="stable")
    out = np.full(size, classes - 1, np.int64)
    alone = min(classes // 4, size)
    out[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    known = rest[(seen[rest] >= 3) & (norm[rest] > 0)]
    centres = classes - alone - 1
    if len(known) >= centres:
        weight = np.sqrt(seen[known].astype(np.float64))
        centre = profile[known[:centres]].copy()
        which = np.zeros(len(known), np.int64)
        for _ in range(8):
            which = (profile[known] @ centre.T).argmax(axis=1)
            for k in range(PROFILE):
                centre[:, k] = np.bincount(which, weight * profile[known, k], centres)
            centre /= np.maximum(np.linalg.norm(centre, axis=1), 1e-6)[:, None]
        out[known] = alone + which
    else:
        out[known] = alone + np.arange(len(known))
    return _like_classes_together(out, sums, classes)


def _like_classes_together(class_of: np.ndarray, sums: np.ndarray, classes: int) -> np.ndarray:
    """Classes but the last renumbered along the main direction of their neighbours' sums, so that groups hold like ones."""
    centre = np.stack([np.bincount(class_of, sums[:, k], classes) for k in range(sums.shape[1])], axis=1)[:-1]
    centre /= np.maximum(np.linalg.norm(centre, axis=1), 1e-6)[:, None]
    centre -= centre.mean(axis=0)
    main = np.linalg.svd(centre, full_matrices=False)[2][0]
    number = np.arange(classes)
    number[np.argsort(centre @ main, kind="stable")] = np.arange(classes - 1)
    return number[class_of]


def in_class_logs(counts: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """ln P(id | class) from corpus counts, one added to each."""
    plus = counts.astype(np.float64) + 1
    return np.log(plus) - np.log(np.maximum(np.bincount(class_of, plus, CLASSES), 1))[class_of]
