"""Secret scan: fixed rules, and a character convolutional network over every other candidate with its surroundings.

The rules' findings are the labelled findings. A candidate is any run of LEAST or more characters of ``[A-Za-z0-9+/_.=-]`` beside
them, without dots at its ends; rejecting is left to the network. The network sees LEFT characters before it, BODY of its
characters, and RIGHT characters after it; it embeds each character by its class and part, applies one convolution, and takes the
largest response in the body and in the surroundings. Over a longer candidate the body slides by one character, and the largest
score counts; the convolution inside the candidate is computed once for each of its characters, whatever places share it.

It is trained in numpy on at most PER_CLASS findings and as many other spans (half of them runs of letters only), chosen by hash
among those of up to SAMPLED characters. Spans are split as wholes into three parts: one to fit (a longer span gives a window for
each BODY characters, and half of the windows get the surroundings of an ordinary span, so that the network also learns what a
secret looks like without its usual label), one to calibrate the scores of whole spans, in both forms, and to set the threshold
with the least false alarms that finds RECALL of its findings, and one that only reports recall and false alarms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import power_tables, map_batches, mix, packed, text_blocks

KINDS = ("assign", "access", "hex")
LEFT, BODY, RIGHT = 24, 48, 16
# The rules find secrets from this length on.
LEAST = 6
PER_CLASS = 2000
RECALL = 0.95
WIDTH, FILTERS, EMBEDDING = 5, 24, 12
EPOCHS, BATCH = 12, 64
# Longest span of the sample; the scan itself has no such bound. Shares of the parts to fit and to calibrate; the rest reports.
SAMPLED = 2048
FIT, CALIBRATE = 0.6, 0.2

# The rules.
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Character classes: letters and digits each for itself, some marks, and three classes for the rest.
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n=:\"'/+_-."
_CODE = np.full(128, len(_ALPHABET) + 1, np.uint8)
for _i, _c in enumerate(_ALPHABET):
    _CODE[ord(_c)] = _i + 1
_CLASSES = len(_ALPHABET) + 3  # 0 is padding, the last is everything beyond ASCII
_PART = np.repeat([0, 1, 2], [LEFT, BODY, RIGHT]) * _CLASSES
_SIZE = LEFT + BODY + RIGHT
_IN_RUN = np.zeros(256, bool)
_IN_RUN[_CODE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.=-"]]] = True
_DOT = _CODE[ord(".")]
_LETTERS = 52  # the first codes
_CODE_KEYS = np.random.default_rng(31).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
# Padding between the texts of a block.
_GAP = max(LEFT, RIGHT)
# Windows or places scored at a time, and shorter bodies for short spans: with WIDTH or more places of padding the same patches occur.
_AT_A_TIME, _PLACES, _SHORT = 512, 1 << 13, (16, 24)


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the secret itself) of the rules' findings, leftmost and not overlapping per kind."""
    found = [(*m.span(), "assign", *m.span(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST]
    found += [(*m.span(), "access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run that is long enough as a whole is found whole; shorter ones hold no part that is.
    found += [(*m.span(), "hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _codes(part: str) -> np.ndarray:
    points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], _CLASSES - 1).astype(np.uint8)


def window(text: str, start: int, end: int, at: int = 0) -> bytes:
    """The character classes of a span from its character ``at`` on, and of its surroundings; padding where there is none."""
    out = np.zeros(_SIZE, np.uint8)
    left = _codes(text[max(0, start - LEFT) : start])
    out[LEFT - len(left) : LEFT] = left
    body = _codes(text[start + at : min(end, start + at + BODY)])
    out[LEFT : LEFT + len(body)] = body
    right = _codes(text[end : end + RIGHT])
    out[LEFT + BODY : LEFT + BODY + len(right)] = right
    return out.tobytes()


def span_codes(text: str, start: int, end: int) -> bytes:
    """A span as the sample holds it: the classes of LEFT characters before it, of all its characters, and of RIGHT after it."""
    codes, first = _laid_out([text])
    return codes[first[0] + start - LEFT : first[0] + end + RIGHT].tobytes()


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The character classes of all texts with padding before, between and after them, and where each text starts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes + _GAP) - sizes
    gap = " " * _GAP
    codes = _codes(gap + gap.join(texts) + gap)
    codes[(np.append(0, first + sizes)[:, None] + np.arange(_GAP)).ravel()] = 0
    return codes, first


def candidates(codes: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all candidates outside the places that are taken."""
    inside = _IN_RUN[codes] & ~taken
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    ink = np.flatnonzero(inside & (codes != _DOT))
    low, high = np.searchsorted(ink, start), np.searchsorted(ink, end)
    low, high = low[high > low], high[high > low]
    start, end = ink[low], ink[high - 1] + 1
    long = end - start >= LEAST
    return start[long], end[long]


def _cut(codes: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray, width: int = BODY) -> np.ndarray:
    """Windows as rows; ``at`` is where the body begins."""
    body = at[:, None] + np.arange(width)
    inner = np.where(body < end[:, None], codes[np.minimum(body, len(codes) - 1)], 0)
    return np.concatenate([codes[start[:, None] + np.arange(-LEFT, 0)], inner.astype(np.uint8), codes[end[:, None] + np.arange(RIGHT)]], axis=1)


def _pieces(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each span once for each BODY characters of it, with the start of that body; the last one ends with the span."""
    many = -(-(end - start) // BODY)
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start, end = np.repeat(start, many), np.repeat(end, many)
    return start, end, np.minimum(start + number * BODY, np.maximum(start, end - BODY))


def kind_of(value: str) -> str:
    """The kind whose form an added span has."""
    if re.fullmatch(r"[0-9a-f]+", value):
        return "hex"
    return "access" if re.fullmatch(r"[A-Z0-9]+", value) else "assign"


def _block(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list, np.ndarray, np.ndarray]:
    """Laid-out classes, starts of the texts, the rules' findings of each text, starts and ends of the candidates."""
    codes, first = _laid_out(texts)
    taken, base = np.zeros(len(codes), bool), []
    for text, shift in zip(texts, first, strict=True):
        base.append(base_spans(text))
        for a, b, *_ in base[-1]:
            taken[shift + a : shift + b] = True
    return codes, first, base, *candidates(codes, taken)


def _span_keys(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each span with its surroundings, equal for equal ones in every block."""
    up, down = power_tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_CODE_KEYS[codes] * up[: len(codes)], out=sums[1:])
    low, high = start - LEFT, end + RIGHT
    return (mix((sums[high] - sums[low]) * down[low]) >> np.uint64(1)).astype(np.int64)


def _sampler(per_class: int):
    """Per task, the findings (label 0), candidates with a digit or mark (1) and of letters only (2) with the least keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = (per_class, per_class // 2, per_class // 2)
        held: list[dict[int, bytes]] = [{} for _ in most]
        for batch in batches:
            for block in text_blocks(batch, "text"):
                codes, first, base, start, end = _block(block.column("text").to_pylist())
                found = np.array([(shift + c, shift + d) for shift, spans in zip(first, base, strict=True) for *_, c, d in spans], np.int64).reshape(-1, 2)
                marks = np.append(0, np.cumsum(codes > _LETTERS))
                plain = marks[start] == marks[end]
                for label, (a, b) in enumerate(((found[:, 0], found[:, 1]), (start[~plain], end[~plain]), (start[plain], end[plain]))):
                    short = b - a <= SAMPLED
                    a, b = a[short], b[short]
                    key, index = np.unique(_span_keys(codes, a, b), return_index=True)
                    for k, i in zip(key[: most[label]].tolist(), index[: most[label]].tolist(), strict=True):
                        held[label].setdefault(k, codes[a[i] - LEFT : b[i] + RIGHT].tobytes())
                    if len(held[label]) > most[label]:
                        held[label] = {k: held[label][k] for k in sorted(held[label])[: most[label]]}
        for label, spans in enumerate(held):
            if spans:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(spans), label, np.int32)), pa.array(list(spans), pa.int64()), pa.array(list(spans.values()), pa.binary())],
                    ["label", "key", "w"],
                )

    return run


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    dense: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5
    # Shares of the findings and of the other spans of the third part, in both forms, that reach the threshold.
    recall: float = float("nan")
    false_alarms: float = float("nan")

    def _pool(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Responses (n, places, filters) with the patches they come from, and which place was the largest in each part."""
        vectors = self.embedding[codes]
        patches = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH, axis=1).transpose(0, 1, 3, 2)
        patches = patches.reshape(len(codes), _SIZE - WIDTH + 1, WIDTH * EMBEDDING)
        return np.maximum(patches @ self.filters + self.shift, 0), patches, vectors

    def raw(self, codes: np.ndarray) -> np.ndarray:
        response, _, _ = self._pool(codes)
        return self._features(response)[0] @ self.dense

    @staticmethod
    def _features(response: np.ndarray) -> tuple[np.ndarray, list[tuple[slice | np.ndarray, np.ndarray]]]:
        places = np.arange(response.shape[1])
        body = (places >= LEFT - WIDTH + 1) & (places < LEFT + BODY)
        parts, picks = [], []
        for where in (np.flatnonzero(body), np.flatnonzero(~body)):
            at = where[response[:, where].argmax(axis=1)]
            picks.append(at)
            parts.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
        return np.concatenate([*parts, np.ones((len(response), 1))], axis=1), picks

    def score(self, windows: list[bytes]) -> np.ndarray:
        out = np.zeros(len(windows))
        for low in range(0, len(windows), 512):
            codes = to_codes(windows[low : low + 512])
            out[low : low + 512] = 1 / (1 + np.exp(-np.clip(self.slope * self.raw(codes) + self.offset, -40, 40)))
        return out

    @cached_property
    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The convolution of two characters, of the next two and of the last one, for each class and part of them."""
        parts = self.filters.reshape(WIDTH, EMBEDDING, FILTERS)
        one = np.stack([self.embedding @ parts[j] for j in range(WIDTH)])
        pair = lambda j: (one[j][:, None] + one[j + 1][None]).reshape(-1, FILTERS).astype(np.float32)
        return pair(0), pair(2), (one[4] + self.shift).astype(np.float32)

    def _response(self, codes: np.ndarray) -> np.ndarray:
        """The convolution along the last axis, from the tables; classes carry their part already."""
        one, two, last = self._tables
        places = codes.shape[-1] - WIDTH + 1
        pairs = codes[..., :-1] * (3 * _CLASSES) + codes[..., 1:]
        out = one.take(pairs[..., :places], axis=0)
        out += two.take(pairs[..., 2 : 2 + places], axis=0)
        out += last.take(codes[..., 4 : 4 + places], axis=0)
        return out

    def _combined(self, body: np.ndarray, around: np.ndarray) -> np.ndarray:
        return np.maximum(np.concatenate([body, around], axis=1), 0) @ self.dense[:-1] + self.dense[-1]

    def _fast(self, windows: np.ndarray, width: int) -> np.ndarray:
        """Raw scores of windows whose body has so many places, from the tables."""
        response = self._response(windows + np.repeat([0, 1, 2], [LEFT, width, RIGHT]) * _CLASSES)
        low, high = LEFT - WIDTH + 1, LEFT + width
        around = np.maximum(response[:, :low].max(axis=1), response[:, high:].max(axis=1))
        return self._combined(response[:, low:high].max(axis=1), around)

    def _sliding(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, span: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Raw scores of bodies that begin at ``at`` in spans longer than BODY; places of a span are neighbours.

        A body's largest response is that of its inner patches - a running maximum over responses computed once for each character -
        and of the WIDTH - 1 patches on either side that reach into the surroundings.
        """
        inner = BODY - WIDTH + 1
        new = np.flatnonzero(np.concatenate([[True], span[1:] != span[:-1]]))
        many = np.diff(np.append(new, len(span)))
        # Per span of this chunk, the characters from its first body's first to its last body's last.
        size = many + BODY - 1
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(at[new], size)
        inside = self._response(codes[place].astype(np.int64) + _CLASSES)
        width = 1
        while width * 2 <= inner:
            inside[: len(inside) - width] = np.maximum(inside[: len(inside) - width], inside[width:])
            width *= 2
        rest = inner - width
        first = np.arange(len(span)) + np.repeat((np.cumsum(size) - size) - (np.cumsum(many) - many), many)
        body = np.maximum(inside[first], inside[np.minimum(first + rest, len(inside) - 1)])
        reach = WIDTH - 1
        left = codes[start[span][:, None] + np.arange(-reach, 0)].astype(np.int64)
        head = np.concatenate([left, codes[at[:, None] + np.arange(reach)] + _CLASSES], axis=1)
        right = codes[end[span][:, None] + np.arange(reach)].astype(np.int64) + 2 * _CLASSES
        tail = np.concatenate([codes[at[:, None] + np.arange(BODY - reach, BODY)].astype(np.int64) + _CLASSES, right], axis=1)
        for edge in (head, tail):
            body = np.maximum(body, self._response(edge).max(axis=1))
        own = span[new]
        before = self._response(codes[start[own][:, None] + np.arange(-LEFT, 0)].astype(np.int64)).max(axis=1)
        after = self._response(codes[end[own][:, None] + np.arange(RIGHT)].astype(np.int64) + 2 * _CLASSES).max(axis=1)
        return self._combined(body, np.repeat(np.maximum(before, after), many, axis=0))

    def raw_spans(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The largest raw score of each span over all places of the body in it."""
        out, size = np.full(len(start), -np.inf), end - start
        group = np.searchsorted(np.array(_SHORT) - WIDTH, size)
        for i, width in enumerate((*_SHORT, BODY)):
            chosen = np.flatnonzero((group == i) & (size <= BODY))
            for low in range(0, len(chosen), _AT_A_TIME):
                part = chosen[low : low + _AT_A_TIME]
                out[part] = self._fast(_cut(codes, start[part], end[part], start[part], width), width)
        long = np.flatnonzero(size > BODY)
        ends = np.cumsum(size[long] - BODY + 1)
        for low in range(0, int(ends[-1]) if len(ends) else 0, _PLACES):
            number = np.arange(low, min(low + _PLACES, ends[-1]))
            which = np.searchsorted(ends, number, "right")
            span = long[which]
            at = start[span] + number - np.where(which > 0, ends[which - 1], 0)
            np.maximum.at(out, span, self._sliding(codes, start, end, span, at))
        return out

    def score_spans(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw_spans(codes, start, end) + self.offset, -40, 40)))


def to_codes(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, _SIZE).astype(np.int64) + _PART


def _joined(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the sample one after the other: classes, and where each begins and ends."""
    codes = np.frombuffer(b"".join(spans), np.uint8)
    sizes = np.array([len(w) for w in spans], np.int64)
    begin = np.cumsum(sizes) - sizes
    return codes, begin + LEFT, begin + sizes - RIGHT


def _blinded(spans: list[bytes], others: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """The spans with the surroundings of ordinary ones."""
    picks = rng.choice(len(others), len(spans))
    return [others[i][:LEFT] + w[LEFT : len(w) - RIGHT] + others[i][len(others[i]) - RIGHT :] for w, i in zip(spans, picks, strict=True)]


def train(spans: list[bytes], labels: np.ndarray, seed: int = 5) -> Network | None:
    """The trained and calibrated network; None without spans of both classes in the part to fit. Spans are as ``span_codes`` gives them."""
    labels = np.asarray(labels, float)
    if len(set(labels.tolist())) < 2 or len(labels) < 20:
        return None
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (3 * _CLASSES, EMBEDDING)), rng.normal(0, 0.15, (WIDTH * EMBEDDING, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS + 1)
    )
    # Each class is split on its own, span by span.
    place = np.zeros(len(spans))
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        place[rng.permutation(own)] = (np.arange(len(own)) + 0.5) / len(own)
    fit, held = np.flatnonzero(place < FIT), np.flatnonzero((place >= FIT) & (place < FIT + CALIBRATE))
    last = np.flatnonzero(place >= FIT + CALIBRATE)
    ordinary = [spans[i] for i in fit if labels[i] == 0]
    if not ordinary or len(set(labels[fit].tolist())) < 2:
        return None
    whole, start, end = _joined([spans[i] for i in fit])
    many = -(-(end - start) // BODY)
    label = np.repeat(labels[fit], many)
    codes = _cut(whole, *_pieces(start, end)).astype(np.int64) + _PART
    weight = np.where(label > 0, 0.5 / max(label.mean(), 1e-3), 0.5 / max(1 - label.mean(), 1e-3))
    sizes = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (net.embedding, net.filters, net.shift, net.dense)]
    hidden = np.r_[0:LEFT, LEFT + BODY : _SIZE]
    others = np.flatnonzero(label == 0)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(codes))
        for low in range(0, len(order), BATCH):
            at = order[low : low + BATCH]
            now = codes[at].copy()
            blind = np.flatnonzero(rng.random(len(at)) < 0.5)
            now[np.ix_(blind, hidden)] = codes[np.ix_(rng.choice(others, len(blind)), hidden)]
            step += 1
            for (p, one, two), slope in zip(sizes, _gradients(net, now, label[at], weight[at]), strict=True):
                one += 0.1 * (slope - one)
                two += 0.01 * (slope**2 - two)
                p -= 0.005 * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)

    def both_forms(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chosen = [spans[i] for i in part]
        return net.raw_spans(*_joined(chosen + _blinded(chosen, ordinary, rng))), np.tile(labels[part], 2)

    _calibrate(net, *both_forms(held))
    if len(last):
        raw, truth = both_forms(last)
        sure = 1 / (1 + np.exp(-np.clip(net.slope * raw + net.offset, -40, 40))) >= net.threshold
        net.recall, net.false_alarms = (float(sure[truth == c].mean()) if (truth == c).any() else float("nan") for c in (1, 0))
    return net


def _gradients(net: Network, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    response, patches, _ = net._pool(codes)
    features, picks = net._features(response)
    error = weight * (1 / (1 + np.exp(-np.clip(features @ net.dense, -40, 40))) - labels) / len(labels)
    dense = features.T @ error + 1e-4 * net.dense
    back = np.zeros_like(response)
    for part, at in enumerate(picks):
        slope = error[:, None] * net.dense[part * FILTERS : (part + 1) * FILTERS]
        active = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] > 0
        np.put_along_axis(back, at[:, None, :], (slope * active)[:, None, :], axis=1)
    filters = np.tensordot(patches, back, axes=([0, 1], [0, 1]))
    shift = back.sum(axis=(0, 1))
    through = (back @ net.filters.T).reshape(len(codes), -1, WIDTH, EMBEDDING)
    vectors = np.zeros((len(codes), _SIZE, EMBEDDING))
    for j in range(WIDTH):
        vectors[:, j : j + through.shape[1]] += through[:, :, j]
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, codes.reshape(-1), vectors.reshape(-1, EMBEDDING))
    return [embedding, filters, shift, dense]


def _calibrate(net: Network, raw: np.ndarray, labels: np.ndarray) -> Network:
    """Platt scaling on the raw scores of held-out spans, then the threshold that keeps the recall."""
    if len(set(labels.tolist())) < 2:
        return net
    scale = max(raw.std(), 1e-6)
    x, slope, offset = raw / scale, 1.0, 0.0
    # Smoothed targets keep the slope finite where the classes are apart.
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(500):
        error = 1 / (1 + np.exp(-(slope * x + offset))) - target
        slope, offset = slope - 0.5 * (error * x).mean(), offset - 0.5 * error.mean()
    # A larger raw score is never a smaller score, so the largest of a span's places stays the largest.
    net.slope, net.offset = max(slope, 1e-6) / scale, offset
    scores = 1 / (1 + np.exp(-np.clip(net.slope * raw + net.offset, -40, 40)))
    hits, misses = np.sort(scores[labels > 0]), scores[labels == 0]
    # The least false alarms that the recall allows; of the thresholds that give them, the middle of the gap below.
    top = hits[int(np.floor((1 - RECALL) * len(hits)))]
    below = misses[misses < top].max(initial=0.0)
    least = hits[hits > below].min(initial=top)
    middle = (below + least) / 2
    # One half where that finds as many: it costs no held-out finding.
    net.threshold = 0.5 if middle < 0.5 <= least else float(middle)
    return net


def _apply(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))
        for batch in batches:
            net = shared.value
            for block in text_blocks(batch, "text"):
                texts = block.column("text").to_pylist()
                codes, first, found, start, end = _block(texts)
                base = [[{"start": a, "end": b, "kind": k, "score": 1.0} for a, b, k, *_ in spans] for spans in found]
                added: list[list[dict]] = [[] for _ in texts]
                if net is not None and len(start):
                    scores = net.score_spans(codes, start, end)
                    sure = np.flatnonzero(scores >= net.threshold)
                    rows = np.searchsorted(first, start[sure], "right") - 1
                    for i, row in zip(sure.tolist(), rows.tolist(), strict=True):
                        a, b = int(start[i] - first[row]), int(end[i] - first[row])
                        added[row].append({"start": a, "end": b, "kind": kind_of(texts[row][a:b]), "score": float(scores[i])})
                yield pa.RecordBatch.from_arrays([block.column("row"), pa.array(base, span), pa.array(added, span)], ["row", "base", "added"])

    return run


def _samples(given: DataFrame, per_class: int) -> tuple[list[bytes], np.ndarray]:
    """Findings and other spans with their surroundings, at most ``per_class`` of each; the same for any partitioning."""
    rows = map_batches(given.select("text"), _sampler(per_class), "label int, key bigint, w binary").distinct()
    rank = F.row_number().over(Window.partitionBy("label").orderBy("key", "w"))
    most = F.when(F.col("label") == 0, per_class).otherwise(per_class // 2)
    chosen = rows.withColumn("rank", rank).where(F.col("rank") <= most).orderBy("label", "rank").collect()
    return [bytes(r["w"]) for r in chosen], np.array([float(r["label"] == 0) for r in chosen])


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None, per_class: int = PER_CLASS) -> DataFrame:
    """``row`` (the columns ``keep``, or all, as a struct), ``base`` and ``added``: spans (start, end, kind, score) in code points.

    NULL counts as empty and has no spans. Repeated rows get the same spans. Without enough findings there is no network
    and nothing is added. An empty table gives an empty result.
    """
    given, kind = packed(docs, keep, text=text)
    given = given.select("row", F.coalesce("text", F.lit("")).alias("text"))
    net = docs.sparkSession.sparkContext.broadcast(train(*_samples(given, per_class)))
    out = "array<struct<start:int,end:int,kind:string,score:double>>"
    return map_batches(given, _apply(net), f"row {kind}, base {out}, added {out}")


def _listing(spans):
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s["end"].alias("c"), s["kind"].alias("d"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")


def digest_columns(found: DataFrame) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("row.doc_id").alias("doc_id"), *map(count, KINDS), F.sha2(_listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listing(F.concat("base", "added")).alias("spans"),
    )
