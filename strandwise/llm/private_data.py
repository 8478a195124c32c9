"""Personal data: base patterns, and a character-level bidirectional LSTM with a CRF, trained in numpy, that adds spans."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Base patterns. Possessive digits only save retries inside a run of digits, which can't change a match.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Hidden units a direction, values of a character, tags (0: none, then KINDS), length of the windows that are trained on,
#: length of those that are decoded, and the step between them.
HIDDEN, EMBEDDED, TAGS, TRAINED, WINDOW, HOP = 12, 12, 5, 96, 480, 448
#: Labelled windows made for the fit, those that a pass trains on at random, and beside them at most those that the model
#: tags wrongly, of a third of the windows, looked through in turn; passes; and the log-odds against plain text that a span needs to be added.
EXAMPLES, DRAWN, WRONG, PASSES, LEAST_ODDS = 16_000, 3000, 1500, 14, 4.0
#: Characters of a document that the fit looks at, and windows that go through the network at a time: no power of two, as rows of
#: such a length fall on the same lines of the cache when scores are turned from steps to windows.
CONTEXT, BATCH = 4000, 752
#: Documents looked at for each one whose text labelled spans are set into, on average.
SPARE = 8


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping emails. If the start of a run of name characters fails, so do its other characters; so only
    starts of runs and ends of matches are tried, and a long run costs no more than its length."""
    out, at = [], 0
    while found := (_EMAIL.match(text, at) if at else None) or _EMAIL_RUN.search(text, at):
        at = found.end()
        out.append(("email", found.start(), at))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind; leftmost and non-overlapping within a kind."""
    out = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ------------------------------------------------------------------ the model


@dataclass
class Tagger:
    """Embeddings, LSTM weights of both directions (gates f, o, g; a cell takes in what it forgets: i = 1 - f), emissions and transitions."""

    embed: np.ndarray
    lstm: list[np.ndarray]
    out: np.ndarray
    trans: np.ndarray


def char_classes(text: str) -> np.ndarray:
    """Class of each character: ASCII as itself, other letters, digits and the rest as one each; 0 is padding."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, np.maximum(codes, 1), 128).astype(np.int64)


CLASSES = 129


#: The least slope that the fit takes for the cubic, so that a gate that is shut for good in some windows can open again. More
#: of it (0.15) let the fit diverge.
LEAST_SLOPE = 0.02


def _bent(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A cubic in place of tanh, and its slope: the same value and slope at 0, 1 from 1.5 on. An exponential costs several times
    as much, and there is one for each gate of each character."""
    t = np.clip(x * (2 / 3), -1, 1)
    square = t * t
    return t * (1.5 - 0.5 * square), np.maximum(1 - square, LEAST_SLOPE)


def _lstm(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, list]:
    """x: (steps, batch, EMBEDDED); w: (EMBEDDED + HIDDEN + 1, 3 * HIDDEN). As 1 / (1 + exp(-x)) is (1 + tanh(x / 2)) / 2, so
    the gates are with the cubic."""
    steps, n, _ = x.shape
    h = c = np.zeros((n, HIDDEN), x.dtype)
    out, kept = np.empty((steps, n, HIDDEN), x.dtype), []
    from_x = x.reshape(-1, EMBEDDED) @ w[:EMBEDDED] + w[-1]
    from_x = from_x.reshape(steps, n, 3 * HIDDEN)
    scale = np.where(np.arange(3 * HIDDEN) < 2 * HIDDEN, 0.5, 1).astype(x.dtype)
    for t in range(steps):
        z, slope = _bent((from_x[t] + h @ w[EMBEDDED:-1]) * scale)
        gates, g = 0.5 + 0.5 * z[:, : 2 * HIDDEN], z[:, 2 * HIDDEN :]
        f, o = gates[:, :HIDDEN], gates[:, HIDDEN:]
        before = (h, c)
        c = f * c + (1 - f) * g
        tc, slope_c = _bent(c)
        h = o * tc
        out[t] = h
        kept.append((before, f, o, g, tc, slope * scale**2, slope_c))
    return out, kept


def _lstm_back(x, w, kept, dout):
    dw, dx = np.zeros_like(w), np.zeros_like(x)
    dh = dc = np.zeros_like(dout[0])
    for t in range(len(x) - 1, -1, -1):
        (h0, c0), f, o, g, tc, slope, slope_c = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * slope_c
        dz = np.concatenate([dc * (c0 - g), dh * tc, dc * (1 - f)], 1) * slope
        dw[:EMBEDDED] += x[t].T @ dz
        dw[EMBEDDED:-1] += h0.T @ dz
        dw[-1] += dz.sum(0)
        dx[t] = dz @ w[:EMBEDDED].T
        dh, dc = dz @ w[EMBEDDED:-1].T, dc * f
    return dw, dx


#: Half of the cubic is s * (LEAD - s * s), for s = x * SCALE within EDGE of 0.
EDGE, LEAD = 4 ** (-1 / 3), 0.75 * 4 ** (1 / 3)
SCALE = EDGE * 2 / 3


def _passed(codes: np.ndarray, inputs: np.ndarray, w: np.ndarray, last: np.ndarray, out: np.ndarray) -> None:
    """Adds to out (steps, TAGS, windows) what one direction gives to each tag. codes: (steps, windows); inputs: values of each
    class; w: weights of hidden values and inputs, times SCALE (half of it for the gates); last: the tags'. Cells and hidden
    values are half of their value, so w and last have twice the weights of hidden values."""
    steps, n = codes.shape
    ins, z, square = np.zeros((HIDDEN + len(inputs), n), np.float32), np.empty((3 * HIDDEN, n), np.float32), np.empty((3 * HIDDEN, n), np.float32)
    h, e, gates = ins[:HIDDEN], ins[HIDDEN:], z[: 2 * HIDDEN]
    f, o, g = (z[k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
    c, now, scores = np.zeros((HIDDEN, n), np.float32), np.empty((HIDDEN, n), np.float32), np.empty((TAGS, n), np.float32)
    for t in range(steps):
        np.take(inputs, codes[t], axis=1, out=e, mode="clip")
        np.matmul(w, ins, out=z)
        np.clip(z, -EDGE, EDGE, out=z)
        np.multiply(z, z, out=square)
        np.subtract(LEAD, square, out=square)
        z *= square
        gates += 0.5
        c -= g
        c *= f
        c += g
        np.multiply(c, 2 * SCALE, out=now)  # a mean of values in the cubic's reach, so within EDGE
        np.multiply(now, now, out=g)
        np.subtract(LEAD, g, out=g)
        now *= g
        np.multiply(o, now, out=h)
        out[t] += np.matmul(last, h, out=scores)


def emissions(model: Tagger, x: np.ndarray) -> np.ndarray:
    """Scores (windows, steps, TAGS) of windows of character classes (windows, steps). Class 0 shuts the gates, so scores don't
    depend on how many of it follow a text."""
    codes = np.ascontiguousarray(x.T)
    inputs = np.concatenate([model.embed.T, np.ones((1, CLASSES), np.float32), np.arange(CLASSES)[None] == 0]).astype(np.float32)
    out = np.empty((x.shape[1], TAGS, len(x)), np.float32)
    out[:] = model.out[-1][:, None]
    scale, shut = np.repeat([SCALE / 2, SCALE / 2, SCALE], HIDDEN), np.repeat([1e4, -1e4, 0], HIDDEN)
    for k, w in enumerate(model.lstm):
        w = (np.concatenate([2 * w[EMBEDDED:-1], w[:EMBEDDED], w[-1:], shut[None]]) * scale).astype(np.float32)
        last, back = 2 * model.out[k * HIDDEN : (k + 1) * HIDDEN].T, -1 if k else 1
        _passed(codes[::back], inputs, w.T.copy(), last.copy(), out[::back])
    return out.transpose(2, 0, 1)


def viterbi(scores: np.ndarray, trans: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
    """Best tags (n, steps) under scores (n, steps, TAGS) and transitions. sizes: the steps of each row that count."""
    n, steps, _ = scores.shape
    best, back = scores[:, 0], np.empty((steps, n, TAGS), np.int64)
    for t in range(1, steps):
        through = best[:, :, None] + trans[None]
        now = through.max(1) + scores[:, t]
        back[t] = through.argmax(1)
        if sizes is not None and (over := t >= sizes).any():
            now[over], back[t, over] = best[over], np.arange(TAGS)
        best = now
    tags = np.empty((n, steps), np.int64)
    tags[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
    return tags


def _crf_gradient(scores, trans, gold):
    """Gradients of the negative log-likelihood, by forward and backward sums."""
    n, steps, _ = scores.shape
    add = lambda a, axis: np.log(np.exp(a - (most := a.max(axis, keepdims=True))).sum(axis)) + most.squeeze(axis)
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[:, 0] = scores[:, 0]
    for t in range(1, steps):
        alpha[:, t] = add(alpha[:, t - 1, :, None] + trans[None], 1) + scores[:, t]
    for t in range(steps - 2, -1, -1):
        beta[:, t] = add(trans[None] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    z = add(alpha[:, -1], 1)
    ds = np.exp(alpha + beta - z[:, None, None])
    pairs = np.exp(alpha[:, :-1, :, None] + trans[None, None] + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]).sum((0, 1))
    rows = np.arange(n)[:, None]
    ds[rows, np.arange(steps)[None, :], gold] -= 1
    np.add.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), -1)
    return ds, pairs


def fit(x: np.ndarray, gold: np.ndarray, passes: int = PASSES, seed: int = 3) -> Tagger:
    """Trains the tagger by Adam on windows of character classes and their tags. Each pass takes DRAWN windows by chance, and
    from the third one on as many as WRONG of those that the model so far tags wrongly, so that it meets the rare hard ones."""
    rng = np.random.default_rng(seed)
    init = lambda *s: rng.normal(0, 0.25, s).astype(np.float32)
    params = [init(CLASSES, EMBEDDED), init(EMBEDDED + HIDDEN + 1, 3 * HIDDEN), init(EMBEDDED + HIDDEN + 1, 3 * HIDDEN), init(2 * HIDDEN + 1, TAGS), np.zeros((TAGS, TAGS), np.float32)]
    for w in params[1:3]:
        w[-1, :HIDDEN] = 1
    first, second, steps = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for turn in range(passes):
        order = rng.permutation(len(x))[:DRAWN]
        if turn >= 2:
            now = _rounded(params)
            third = np.arange(turn % 3, len(x), 3)
            wrong = [third[at : at + BATCH][(viterbi(emissions(now, x[third[at : at + BATCH]]), now.trans) != gold[third[at : at + BATCH]]).any(1)] for at in range(0, len(third), BATCH)]
            order = rng.permutation(np.concatenate([order, rng.permutation(np.concatenate(wrong))[:WRONG]]))
        rate = 0.025 * (1 - turn / passes) + 0.001
        for at in range(0, len(order), 128):
            part = order[at : at + 128]
            e = params[0][x[part].T]
            fo, fk = _lstm(e, params[1])
            ba, bk = _lstm(e[::-1], params[2])
            h = np.concatenate([fo, ba[::-1]], 2)
            scores = (h @ params[3][:-1] + params[3][-1]).transpose(1, 0, 2)
            ds, dt = _crf_gradient(scores, params[4], gold[part])
            ds, dt = ds.transpose(1, 0, 2) / len(part), dt / len(part)
            dh = ds @ params[3][:-1].T
            dout = np.concatenate([h.reshape(-1, 2 * HIDDEN).T @ ds.reshape(-1, TAGS), ds.sum((0, 1))[None]])
            dwf, dxf = _lstm_back(e, params[1], fk, dh[:, :, :HIDDEN])
            dwb, dxb = _lstm_back(e[::-1], params[2], bk, dh[::-1, :, HIDDEN:])
            de = np.zeros_like(params[0])
            np.add.at(de, x[part].T, dxf + dxb[::-1])
            steps += 1
            for p, g, a, b in zip(params, [de, dwf, dwb, dout, dt], first, second, strict=True):
                g = np.clip(g, -1, 1)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * (a / (1 - 0.9**steps)) / (np.sqrt(b / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return _rounded(params)


def _rounded(params: list[np.ndarray]) -> Tagger:
    p = [q.astype(np.float32) for q in params]
    return Tagger(p[0], p[1:3], p[3], p[4])


# ------------------------------------------------------------------ labelled spans for the fit

#: Ways of writing a value of each kind.
FORMS = 8


def _value(kind: str, rng: np.random.Generator, form: int) -> str:
    """A made-up value of a kind in one of FORMS ways: as the base pattern has it, spelled out, or with other separators."""
    word = lambda a, b: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(a, b)))
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    if kind == "email":
        name = word(3, 9) + ("." + word(3, 8) if rng.random() < 0.4 else "") + (f".{digits(2)}" if rng.random() < 0.4 else "")
        host, top = word(3, 8) + digits(rng.integers(0, 2)), str(rng.choice(["com", "org", "net", "de", "io", "co.uk", "fr", "edu", "example.com"]))
        at, dot = [("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), (" @ ", "."), ("[at]", "."), ("(at)", "[dot]"), (" {at} ", ".")][form]
        out = f"{name}{at}{host}{dot}{top}"
        return out.upper() if rng.random() < 0.15 else out
    if kind == "ip":
        return [".", ".", "[.]", " . ", "(.)", "[dot]", " dot ", "."][form].join(str(n) for n in rng.integers(1, 256, 4)) + (f":{digits(4)}" if form == 7 else "")
    if kind == "card":
        n = digits(15)
        n += next(d for d in "0123456789" if luhn(n + d))
        return [" ", "", "-", ".", " / ", "", "_", "  "][form].join(n[i : i + 4] for i in range(0, 16, 4))
    a, b, c = digits(3), digits(3), digits(4)
    return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{digits(2)} {a} {b} {c}", f"{a}.{b}.{c}", f"tel:{a}{b}{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}"][form]


def _decoy(rng: np.random.Generator) -> str:
    """Digits and marks that are no personal data: keys, counts, dates, prices, versions, times, ranges."""
    n = int(rng.integers(0, 10**6))
    text = lambda k, of: "".join(rng.choice(list(of), k))
    made = [str(n), f"{n % 100}.{n % 7}", f"20{n % 90 + 10}-{n % 12 + 1:02}-{n % 28 + 1:02}", f"${n}.99", f"v{n % 9}.{n % 30}.{n % 4}"]
    made += ["AKIA" + text(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), "password=" + text(20, "0123456789abcdef"), f'token = "{text(40, "0123456789abcdef")}"']
    made += [f"at {n % 24} dot {text(4, 'abcdef')}", f"{n % 999}%", f"{n % 24}:{n % 60:02}", f"{n % 28 + 1}.{n % 12 + 1}.19{n % 90 + 10}", f"{n % 900}-{n % 999}"]
    made += [f"version {n % 9}.{n % 10}", f"{n:,} of {n * 3:,}", "@" + text(7, "abcdefghij"), f"look at {text(5, 'abcdefgh')} dot by dot", f"#{n} [{n % 90}]"]
    made += ["e" * 40 + "!!", f"{n} {n % 77} {n % 13}"]
    return made[int(rng.integers(0, len(made)))]


def labelled_windows(contexts: list[str], examples: int = EXAMPLES, seed: int = 7, forms: tuple[int, ...] = tuple(range(FORMS))) -> tuple[np.ndarray, np.ndarray]:
    """Windows of text and the tag of each character: two fifths are texts of the contexts as they are, mostly about a digit or
    an @ where they have one, with their base spans; the others have a made-up value or decoy set into them."""
    rng = np.random.default_rng(seed)
    contexts = [c for c in contexts if len(c) >= 2 * TRAINED] or ["the quick brown fox and the lazy dog walk on by the long old road and back again to their home " * 4]
    known = [base_spans(c) for c in contexts]
    unsure = [[(m.start(), m.end()) for m in re.finditer(r"[0-9]{14,19}", c) if not luhn(m[0])] for c in contexts]
    marks = [[m.start() for m in re.finditer(r"[0-9@]+", c)] for c in contexts]
    busy = [i for i, m in enumerate(marks) if m]
    x, y = np.zeros((examples, TRAINED), np.int64), np.zeros((examples, TRAINED), np.int64)
    for n in range(examples):
        if n % 5 < 2:
            i = busy[int(rng.integers(len(busy)))] if busy and rng.random() < 0.3 else int(rng.integers(len(contexts)))
            text, at = contexts[i], int(rng.integers(0, len(contexts[i]) - TRAINED + 1))
            if marks[i] and rng.random() < 0.7:
                at = int(np.clip(marks[i][int(rng.integers(len(marks[i])))] - rng.integers(0, TRAINED), 0, len(text) - TRAINED))
            if any(s < at + TRAINED and at < e for s, e in unsure[i]):
                at = next((k for k in rng.integers(0, len(text) - TRAINED + 1, 8).tolist() if not any(s < k + TRAINED and k < e for s, e in unsure[i])), at)
            tags = np.zeros(len(text), np.int64)
            for kind, s, e in known[i]:
                tags[s:e] = KINDS.index(kind) + 1
            x[n], y[n] = char_classes(text[at : at + TRAINED]), tags[at : at + TRAINED]
            continue
        context = contexts[int(rng.integers(len(contexts)))]
        at = int(rng.integers(0, len(context) - 2 * TRAINED + 1))
        kind = int(rng.integers(0, 6))
        value = _value(KINDS[kind], rng, forms[int(rng.integers(len(forms)))]) if kind < 4 else _decoy(rng)
        left, right = re.sub(r"[0-9@]", "e", context[at : at + TRAINED]), re.sub(r"[0-9@]", "e", context[at + TRAINED : at + 2 * TRAINED])
        before, after = str(rng.choice([" ", " ", " ", "\n", " (", ": "])), str(rng.choice([" ", " ", " ", ". ", ", ", "\n", ") ", "!! "]))
        text, tags = left + before + value + after + right, [0] * len(left + before) + [kind + 1 if kind < 4 else 0] * len(value) + [0] * (TRAINED + len(after))
        middle = len(left + before) + len(value) // 2
        start = int(rng.integers(max(0, middle - TRAINED), middle))
        part = text[start : start + TRAINED]
        x[n, : len(part)], y[n, : len(part)] = char_classes(part), tags[start : start + TRAINED]
    return x, y


def fit_on_sample(docs: DataFrame, contexts: int = 200) -> Tagger:
    """Fits the tagger on labelled spans of the texts, and set into the texts, of at most contexts documents, those of the least
    hashes of doc_id; of each the first CONTEXT characters. Only the fit has these bounds. Null, empty and short texts are
    passed over; an empty table leaves a plain English sentence as the only context.

    Every partition sends its least rows to the driver, so only a share of the hash space that should hold SPARE times
    contexts documents is looked at; a larger share follows while too few of its texts are long enough.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("_id"), F.substring("text", 1, CONTEXT).alias("t")).withColumn("h", F.xxhash64("_id")).filter("length(t) >= 200")
    share = SPARE * contexts / max(1, docs.select("doc_id").count())
    while True:
        part = known.filter(F.col("h") < F.lit(int(share * 2**64) - (1 << 63))) if share < 1 else known
        rows = part.orderBy("h", "_id", "t").limit(contexts).collect()
        if len(rows) == contexts or share >= 1:
            return fit(*labelled_windows([r.t for r in rows]))
        share *= SPARE


# ------------------------------------------------------------------ decoding whole texts

_CORE = re.compile(r"[A-Za-z0-9+(](?:.*[A-Za-z0-9])?", re.S)
_NUMBERS = re.compile(r"[0-9]+")


def plausible(kind: str, value: str) -> bool:
    """The exact check of what the tagger marks: a card has 14 to 19 digits whose last one checks, an IP address four numbers up
    to 255 (and a port), a phone 7 to 15 digits, an email words on both sides of an at."""
    numbers = _NUMBERS.findall(value)
    digits = "".join(numbers)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        return 4 <= len(numbers) <= 5 and all(len(n) <= 3 and int(n) <= 255 for n in numbers[:4])
    if kind == "phone":
        return 7 <= len(digits) <= 15
    return re.search(r"[A-Za-z0-9].*(?:@|\bat\b|(?<![A-Za-z])AT(?![A-Za-z])).*[A-Za-z0-9]", value, re.S) is not None


def scored(model: Tagger, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Scores (characters, TAGS) of texts that stand one after the other in codes: windows of WINDOW characters every HOP cover
    each text, and each character takes its scores from the window in which it stands nearest to the middle."""
    margin, out = (WINDOW - HOP) // 2, np.empty((TAGS, len(codes)), np.float32)
    places = []  # where a window starts, its characters, and which of them take their scores from it
    for start, length in zip((np.cumsum(lengths) - lengths).tolist(), lengths.tolist(), strict=True):
        last = max(0, -(-(length - WINDOW) // HOP)) * HOP
        places += [(start + at, min(WINDOW, length - at), margin if at else 0, WINDOW - margin if at < last else min(WINDOW, length - at)) for at in range(0, last + 1, HOP)]
    places.sort(key=lambda place: place[1])
    short = sum(place[1] < WINDOW for place in places)  # in smaller batches, which pad less
    cuts = [*range(0, short, min(BATCH, max(BATCH // 4, short // 4))), *range(short, len(places), BATCH), len(places)]
    for k, end in zip(cuts, cuts[1:], strict=False):
        part = places[k:end]
        x = np.zeros((len(part), part[-1][1]), np.int64)
        for row, (at, size, _, _) in zip(x, part, strict=True):
            row[:size] = codes[at : at + size]
        scores = np.ascontiguousarray(emissions(model, x).transpose(0, 2, 1))
        for row, (at, _, a, b) in zip(scores, part, strict=True):
            out[:, at + a : at + b] = row[:, a:b]
    return out.T


def decoded(model: Tagger, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best tags of each text under its scores and the transitions, as one Viterbi search over the whole text gives them.

    A run of other tags can only be part of a best path if it may gain on plain text: if the most that its characters lead tag 0
    by, with the best transitions within it, outweighs the best ways in and out. So a character is plain for certain if even
    the best run through it gains nothing, by prefix sums and their running extremes, and only the stretches between such
    characters are searched, with the one on either side.
    """
    trans = model.trans
    way_in, way_out, within = (float(x.max()) for x in (trans[0, 1:] - trans[0, 0], trans[1:, 0] - trans[0, 0], trans[1:, 1:] - trans[0, 0]))
    ends = np.cumsum(lengths)
    by_tag = scores.T
    lead = (by_tag[1:].max(0) - by_tag[0]).astype(np.float64) + within
    lead[ends - lengths] -= min(way_in, 0.0)  # a run at a text's border has no way in or out
    lead[ends - 1] -= min(way_out, 0.0)
    total = np.concatenate([[0.0], np.cumsum(lead)])
    ending = total[1:] - np.minimum.accumulate(total[:-1])
    beginning = np.maximum.accumulate(total[:0:-1])[::-1] - total[:-1]
    sure = ending + beginning - lead + way_in + way_out - within < -1e-3
    tags = np.zeros(len(scores), np.int64)
    near = ~sure
    near[:-1] |= ~sure[1:]
    near[1:] |= ~sure[:-1]
    first = np.zeros(len(scores) + 1, bool)
    first[ends - lengths] = True
    begins = np.flatnonzero(near & (first[:-1] | ~np.concatenate([[False], near[:-1]])))
    stops = np.flatnonzero(near & (first[1:] | (np.arange(len(scores)) == len(scores) - 1) | ~np.concatenate([near[1:], [False]]))) + 1
    size = stops - begins
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        longest = max(8, 2 * int(size[order[at]]))
        upto = min(int(np.searchsorted(size[order], longest, "right")), at + max(1, 2_000_000 // longest))
        part = order[at:upto]
        steps = int(size[part[-1]])
        place = begins[part][:, None] + np.arange(steps)
        inside = place < stops[part][:, None]
        place = np.minimum(place, len(scores) - 1)
        padded = scores[place].astype(np.float64)
        padded[..., 1:] -= np.where(sure[place], 1e6, 0.0)[..., None]  # plain for certain
        found = viterbi(padded, trans.astype(np.float64), size[part])
        tags[place[inside]] = found[inside]
        at = upto
    return tags


def odds(model: Tagger, scores: np.ndarray, tags: np.ndarray, s: int, e: int) -> float:
    """Log-odds of the span with its one tag against plain text in its place."""
    k, t = tags[s], model.trans
    return float((scores[s:e, k] - scores[s:e, 0]).sum() + (e - s - 1) * (t[k, k] - t[0, 0]) + t[0, k] + t[k, 0] - 2 * t[0, 0])


def added_spans(model: Tagger, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Spans that the tagger adds to each text's base spans, without overlap with them. Every character of every text goes
    through the network; a text is decoded once, as a whole."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    codes = [char_classes(t) for t in texts]
    lengths = np.array([len(c) for c in codes])
    used = np.flatnonzero(lengths)
    groups = np.split(used, np.flatnonzero(np.diff(np.cumsum(lengths[used]) // 2_000_000)) + 1) if len(used) else []
    for group in groups:
        joined, size = np.concatenate([codes[n] for n in group]), lengths[group]
        scores = scored(model, joined, size)
        tags = decoded(model, scores, size)
        ends = np.cumsum(size)
        starts = ends - size
        change = np.flatnonzero(np.concatenate([[True], (tags[1:] != tags[:-1])]))
        cuts = np.unique(np.concatenate([change, starts]))
        cuts = cuts[tags[cuts] > 0]
        change = np.append(change, len(tags))
        for s in cuts:
            n = int(np.searchsorted(ends, s, "right"))
            e = min(int(change[np.searchsorted(change, s, "right")]), int(ends[n]))
            if odds(model, scores, tags, int(s), e) < LEAST_ODDS:
                continue
            row, s, e = int(group[n]), int(s - starts[n]), int(e - starts[n])
            found, kind = _CORE.search(texts[row][s:e]), KINDS[tags[starts[n] + s] - 1]
            if found and plausible(kind, found[0]):
                s, e = s + found.start(), s + found.end()
                if not any(s < y and x < e for _, x, y in base[row]):
                    out[row].append((kind, s, e))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def find_private(docs: DataFrame, model: Tagger) -> DataFrame:
    """docs with private added: an array of (kind, start, end, base), code points, end exclusive; and counts and digests
    n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (columns of these names are replaced).

    Null and empty texts have no spans; rows that repeat a text get the same spans each; an empty table gives no rows. Of
    tags that tie the lower one is taken. The model (20 KB) is broadcast; each text is read whole, however long, and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "private"]

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, private array<struct<kind:string,start:long,end:long,base:boolean>>")
    def run(text: pd.Series) -> pd.DataFrame:
        texts = text.tolist()
        base = [base_spans(t) for t in texts]
        more = added_spans(shared.value, texts, base)
        rows = []
        for b, m in zip(base, more, strict=True):
            counts = [sum(k == kind for k, _, _ in b) for kind in KINDS]
            private = [{"kind": k, "start": s, "end": e, "base": own} for own, part in ((True, b), (False, m)) for k, s, e in part]
            rows.append((*counts, hashlib.sha256(_joined(b).encode()).hexdigest(), _joined(b + m), private))
        return pd.DataFrame(rows, columns=names)

    kept = [f"`{c}`" for c in docs.columns if c not in names]
    out = docs.select(F.struct(*kept).alias("_row"), run(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_found"))
    return out.select("_row.*", *[F.col(f"_found.{n}").alias(n) for n in names])


def masked(docs: DataFrame, model: Tagger) -> DataFrame:
    """docs with each span of text replaced by its kind in angle brackets; columns as given, null texts stay null."""
    names = docs.columns
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text")

    @F.pandas_udf("string")
    def cover(text: pd.Series, private: pd.Series) -> pd.Series:
        def one(t, spans):
            if t is None:
                return None
            at, out = 0, []
            for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
                if s["start"] >= at:
                    out += [t[at : s["start"]], f"<{s['kind']}>"]
                    at = s["end"]
            return "".join([*out, t[at:]])

        return pd.Series([one(t, s) for t, s in zip(text, private, strict=True)], dtype=object)

    found = find_private(tagged, model).withColumn("_text", cover("text", "private"))
    return found.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in names])
