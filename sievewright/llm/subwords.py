"""Hashed character n-grams of whole texts, and the linear model over their average.

A text is lower-cased, everything but letters becomes a space, and the n-grams of
each word (with the space before and after it) are hashed into buckets.  The model
embeds every bucket, averages the embeddings of a text and applies a linear
softmax: with the layer folded into the buckets, a prediction is an average of
table rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np

#: Which of the first 65,536 code points are letters.
_LETTER = np.array([chr(i).isalpha() for i in range(65_536)])
#: What the ``shape`` view shows of them: the kind of letter, digit or space, or the character itself.
_SHAPE = np.array([65 if c.isupper() else 97 if c.isalpha() else 48 if c.isdigit() else 32 if c.isspace() else ord(c) for c in map(chr, range(65_536))], dtype=np.uint32)
#: Lengths, in characters, at which held-back texts are cut to see how unfamiliar a text of a learned class may look.
PIECES = (4, 8, 16, 32, 64, 128, 256, 512, 1024)
#: Temperatures that calibration tries.
TEMPERATURES = np.geomspace(1 / 64, 64, 97)
#: Bits for a bucket that no learned text fills; a uniform share has 0.
UNSEEN = -6.0
_MULTIPLY = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], dtype=np.uint32)


def code_points(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts, each framed by spaces, and the first place of each text."""
    framed = [f" {t.lower() if lower else t} " for t in texts]
    flat = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    size = np.fromiter(map(len, framed), dtype=np.int64, count=len(framed))
    return flat, np.cumsum(size) - size


def ngrams(plain: np.ndarray, n: int, buckets: int, inner: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, buckets) of the n-grams of ``plain``; with ``inner``, of those whose inner characters it marks."""
    count = len(plain) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = None
    if inner is not None:
        ok = inner[1 : 1 + count].copy()
        for k in range(2, n - 1):
            ok &= inner[k : k + count]
        at = np.flatnonzero(ok)
    h = np.full(count if at is None else len(at), n, dtype=np.uint32)
    for k in range(n):
        h = (h ^ (plain[k : k + count] if at is None else plain[at + k])) * _MULTIPLY[k % 5]
        h ^= h >> np.uint32(15)
    return np.arange(count) if at is None else at, (h % np.uint32(buckets)).astype(np.int64)


def features(texts: list[str], orders: tuple[int, ...], buckets: int, view: str = "letters") -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """([(places, buckets) for each order], first place of each text, letters in each text).

    The ``letters`` view reads lower-cased words and takes everything else for
    spaces; the ``shape`` view reads kinds of characters, and takes all n-grams.
    """
    flat, first = code_points(texts, view == "letters")
    low = np.minimum(flat, 65_535)
    letter = _LETTER[low]
    high = np.flatnonzero(flat > 65_535)
    if len(high):
        found, which = np.unique(flat[high], return_inverse=True)
        letter[high] = np.array([chr(c).isalpha() for c in found.tolist()])[which]
    letters = np.add.reduceat(letter, first, dtype=np.int64) if len(first) else np.empty(0, dtype=np.int64)
    if view == "letters":
        plain, inner = np.where(letter, flat, 32).astype(np.uint32), letter
    else:
        plain, inner = _SHAPE[low], None
    grams = [ngrams(plain, n, buckets, inner) for n in orders]
    if view == "shape":
        grams.append(echoes(texts, first, buckets))
    return grams, first, letters


def echoes(texts: list[str], first: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """One feature, in the last bucket, for each word that repeats one of the two words before it.

    Repetition is a sign of machine-made text that no n-gram of character kinds can
    show; the model learns its weight like that of any other feature.
    """
    count = []
    for t in texts:
        w = t.split()
        count.append(sum(map(eq, w, w[1:])) + sum(map(eq, w, w[2:])))
    owner = np.repeat(np.arange(len(texts)), count)
    return first[owner], np.full(len(owner), buckets - 1)


@dataclass
class SubwordModel:
    """Classes in order; ``table`` (buckets x classes) holds each bucket's share of the logits.

    ``familiar`` holds how common each bucket is in the class where it is commonest
    (bits above a uniform share).  Its average over a text is high for learned
    classes and their mixtures and low for anything else, however sure the softmax
    is.  ``bounds`` has for each length of ``PIECES`` the least average to accept.
    Until texts held back set ``reject_below`` and ``bounds``, all with letters pass.
    """

    classes: list[str]
    table: np.ndarray
    bias: np.ndarray
    orders: tuple[int, ...]
    view: str = "letters"
    temperature: float = 1.0
    reject_below: float = 0.0
    familiar: np.ndarray | None = None
    bounds: np.ndarray | None = None

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits (texts x classes) and the number of letters of each text."""
        return self.read(texts)[:2]

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, letters and average familiarity (0 without a table of it) of each text."""
        grams, first, letters = features(texts, self.orders, len(self.table), self.view)
        total, count, known = np.zeros((len(texts), len(self.classes))), np.zeros(len(texts)), np.zeros(len(texts))
        for at, bucket in grams:
            owner = np.searchsorted(first, at, "right") - 1
            edge = np.flatnonzero(np.diff(owner, prepend=-1))
            if len(edge):
                total[owner[edge]] += np.add.reduceat(self.table[bucket], edge, axis=0, dtype=np.float64)
                count[owner[edge]] += np.diff(np.append(edge, len(owner)))
                if self.familiar is not None:
                    known[owner[edge]] += np.add.reduceat(self.familiar[bucket], edge, dtype=np.float64)
        return total / np.maximum(count, 1)[:, None] + self.bias, letters, known / np.maximum(count, 1)

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        z, letters = self.logits(texts)
        return softmax(z / self.temperature), letters

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities, letters, and whether each text is one of a learned class; false without letters."""
        z, letters, known = self.read(texts)
        p = softmax(z / self.temperature)
        accepted = (letters > 0) & (p.max(axis=1) >= self.reject_below)
        if self.bounds is not None:
            accepted &= known >= np.append(-np.inf, self.bounds)[np.searchsorted(PIECES, letters, "right")]
        return p, letters, accepted


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], orders: tuple[int, ...] = (3, 4), buckets: int = 1 << 16, dim: int = 16, epochs: int = 4, rate: float = 0.5, seed: int = 1, hold: float = 0.2, view: str = "letters") -> SubwordModel:
    """Stochastic gradient descent over single texts, then temperature and rejection on the texts held back.

    The order of texts is shuffled with ``seed``, so equal input gives an equal model.
    """
    rng = np.random.default_rng(seed)
    classes = sorted(set(labels))
    y = np.array([classes.index(x) for x in labels])
    order = rng.permutation(len(texts))
    back = set(order[: int(hold * len(texts))].tolist())
    embed = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((len(classes), dim), dtype=np.float32), np.zeros(len(classes), dtype=np.float32)
    rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i in order.tolist():
        if i not in back:
            grams, _, _ = features([texts[i]], orders, buckets, view)
            ids, n = np.unique(np.concatenate([b for _, b in grams]), return_counts=True)
            if len(ids):
                rows[i] = ids, (n / n.sum()).astype(np.float32)
    use, step, steps = list(rows), 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        rng.shuffle(use)
        for i in use:
            ids, share = rows[i]
            hidden = share @ embed[ids]
            error = softmax(out @ hidden + bias).astype(np.float32)
            error[y[i]] -= 1
            lr = np.float32(rate * (1 - step / steps))
            back_to = error @ out
            out -= lr * np.outer(error, hidden)
            bias -= lr * np.float32(0.1) * error
            # the average gives each bucket its share; the usual scaling by the share's size would starve long texts
            embed[ids] -= lr * np.outer(share * np.float32(min(len(ids), 50)), back_to)
            step += 1
    familiar = np.zeros(buckets, dtype=np.float32)
    for c in range(len(classes)):
        own = [rows[i] for i in use if y[i] == c]
        if own:
            filled = np.bincount(np.concatenate([ids for ids, _ in own]), np.concatenate([share for _, share in own]), buckets)
            familiar = np.maximum(familiar, (filled / len(own)).astype(np.float32))
    model = SubwordModel(classes, (embed @ out.T).astype(np.float32), bias.astype(np.float64), orders, view)
    if view == "letters":
        model.familiar = np.log2(np.maximum(familiar * buckets, 2**UNSEEN)).astype(np.float32)
    held = sorted(back)
    if held:
        calibrate(model, [texts[i] for i in held], y[held])
    return model


def calibrate(model: SubwordModel, texts: list[str], y: np.ndarray, lost: float = 0.0005, above: float = 0.09) -> None:
    """Set the temperature of least log loss, and the score below which to reject.

    The temperature is fitted on the held-back texts and, in the ``letters`` view, on
    all their beginnings of the lengths in ``PIECES``: whole texts alone are told
    apart without a mistake, which says nothing of how sure to be.  The rejection score lies ``above`` of the
    way from chance to certainty, or lower if more than the share ``lost`` of right
    predictions would fall below it; it only rejects what looks like no class at
    all.  What looks like a class but is made of other n-grams falls below the least
    familiarity: for each length, the quantile ``lost`` of the held-back texts cut to
    it, less a margin in bits that is the wider the fewer they are.  Short texts vary
    more, so their bound is lower.
    """
    read = lambda xs: [np.concatenate(c) for c in zip(*(model.read(xs[i : i + 64]) for i in range(0, len(xs), 64)))]
    z, _, _ = read(texts)
    cuts = [read([x.strip()[:n] for x in texts]) for n in PIECES] if model.view == "letters" else []
    pooled = np.concatenate([z, *(c[0][c[1] > 0] for c in cuts)])
    truth = np.concatenate([y, *(y[c[1] > 0] for c in cuts)])
    loss = lambda t: -np.log(np.maximum(softmax(pooled / t)[np.arange(len(truth)), truth], 1e-12)).mean()
    model.temperature = float(min(TEMPERATURES, key=loss))
    p = softmax(z / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    if len(right):
        chance = 1 / len(model.classes)
        model.reject_below = float(min(chance + above * (1 - chance), np.quantile(right, lost)))
    if model.familiar is not None:
        pieces = [np.quantile(known[letters > 0], lost) if (letters > 0).any() else -np.inf for _, letters, known in cuts]
        model.bounds = np.minimum.accumulate(pieces[::-1])[::-1] - 1 - np.log2(1 + 100 / len(texts))
