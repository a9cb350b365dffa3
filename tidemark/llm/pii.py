"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions.

Patterns give the base spans of e-mail addresses, IP addresses, payment cards and phone numbers. The network,
written in numpy, finds further ones in notations that the patterns miss, and secrets: keys and tokens that are
assigned a value. It is trained on windows of a bounded sample of documents, labelled by the base spans and by
assignments to telling names, and on the same windows with a span rewritten: local phone numbers, addresses
written out, secrets of other alphabets under other names. Every span has a digit or an at sign, written out or not, so the
network reads the places around these: overlapping windows give scores for each character, windows that
overlap are averaged, and one Viterbi path is decoded over the whole stretch they cover. Very long stretches are
decoded in overlapping pieces, and texts in groups of a bounded number of characters.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, small_batches, stored

KINDS = ("email", "ip", "card", "phone")
#: What the network knows besides.
SECRET = len(KINDS)
NAMES = (*KINDS, "secret")
#: Documents and windows the network is trained on, at most; documents by the lowest hashes of their ids.
SAMPLE_DOCS = 3_000
SAMPLE_WINDOWS = 8_000
#: Characters of a window, and from one window to the next.
WINDOW, STRIDE = 64, 32
#: Characters read on either side of a digit or at sign; stretches that touch are one.
MARGIN = 24
HIDDEN, TAGS = 16, 1 + 2 * len(NAMES)  # nothing, and the first and later characters of each kind
#: Mean probability of its tags from which a decoded span is taken.
CERTAIN = 0.5
#: Characters that are decoded at a time, and of one piece of a stretch; pieces overlap by more than a span has.
DECODED, PIECE, OVERLAP = 100_000, 8_192, 512

ANCHOR = re.compile(r"[0-9@]")
#: At signs written out, besides.
WRITTEN_AT = re.compile(r"[0-9@]|[\[(]at[\])]", re.IGNORECASE)
#: Names whose values are secrets, for the labels of the training windows.
ASSIGNED = re.compile(r"""(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)["']?\s*[:=]\s*["']?([A-Za-z0-9+/_=-]{16,128})(?![A-Za-z0-9+/_=-])""")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A digit before would have begun the match itself, so looking behind changes nothing but the cost of long runs.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def valid_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def valid_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, each at sign looked at once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans in order."""
    if not ANCHOR.search(text):
        return []
    found = [(s, 0, e) for s, e in emails(text)]
    for kind, pattern, valid in ((1, IP, valid_ip), (2, CARD, valid_card), (3, PHONE, valid_phone)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return sorted(found)


# --- the network --------------------------------------------------------------------------------------------

SIGNS = " @.+-()_%:/,;\n\"'=#$&*|"
_SYMBOLS = np.zeros(128, np.uint8)
_SYMBOLS[:] = 1  # other ASCII
_SYMBOLS[ord("a") : ord("z") + 1] = 2
_SYMBOLS[ord("A") : ord("Z") + 1] = 3
_SYMBOLS[ord("0") : ord("9") + 1] = 4
for _i, _c in enumerate(SIGNS):
    _SYMBOLS[ord(_c)] = 6 + _i
N_SYMBOLS = 6 + len(SIGNS)  # 0 stands outside the text, 5 for characters beyond ASCII


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(codes < 128, _SYMBOLS[np.minimum(codes, 127)], 5).astype(np.uint8)


@dataclass
class Network:
    """Parameters by name; ``f`` and ``b`` are the two directions."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        w = {"out": rng.normal(0, 0.3, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS), "moves": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in "fb":
            w[d + "x"] = rng.normal(0, 0.3, (N_SYMBOLS, 4 * HIDDEN))
            w[d + "x"][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
            w[d + "h"] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        return Network({k: v.astype(np.float32) for k, v in w.items()})


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool = False):
    """Hidden states (length, batch, HIDDEN) over symbols (length, batch), and what going back needs."""
    n, batch = x.shape
    h = c = np.zeros((batch, HIDDEN), np.float32)
    out, kept = np.empty((n, batch, HIDDEN), np.float32), []
    for t in range(n):
        z = wx[x[t]] + h @ wh
        gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        last, h = h, o * tc
        out[t] = h
        if keep:
            kept.append((i, f, o, g, before, tc, last))
    return out, kept


def _lstm_back(dout: np.ndarray, x: np.ndarray, wx: np.ndarray, wh: np.ndarray, kept: list):
    dwx, dwh = np.zeros_like(wx), np.zeros_like(wh)
    dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, tc, last = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)])
        np.add.at(dwx, x[t], dz)
        dwh += last.T @ dz
        dh, dc = dz @ wh.T, dc * f
    return dwx, dwh


def emissions(net: Network, x: np.ndarray) -> np.ndarray:
    """Scores (length, batch, TAGS) of symbols (length, batch)."""
    w = net.weights
    ahead, _ = _lstm(x, w["fx"], w["fh"])
    back, _ = _lstm(x[::-1], w["bx"], w["bh"])
    return np.concatenate([ahead, back[::-1]], axis=2) @ w["out"] + w["bias"]


def _marginals(scores: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Tag probabilities (length, batch, TAGS) and expected moves, by scaled forward and backward sums."""
    n, batch, _ = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    m = np.exp(moves)
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((n, batch, 1), np.float32)
    for t in range(n):
        a = (np.exp(first) if t == 0 else alpha[t - 1] @ m) * e[t]
        scale[t] = a.sum(axis=1, keepdims=True)
        alpha[t] = a / scale[t]
    for t in range(n - 2, -1, -1):
        beta[t] = (e[t + 1] * beta[t + 1]) @ m.T / scale[t + 1]
    pairs = np.zeros_like(m)
    for t in range(n - 1):
        pairs += (alpha[t].T @ (e[t + 1] * beta[t + 1] / scale[t + 1])) * m
    return alpha * beta, pairs


def _gradient(net: Network, x: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log likelihood of a batch of windows (length, batch)."""
    w, batch = net.weights, x.shape[1]
    ahead, kept_f = _lstm(x, w["fx"], w["fh"], True)
    back, kept_b = _lstm(x[::-1], w["bx"], w["bh"], True)
    hidden = np.concatenate([ahead, back[::-1]], axis=2)
    prob, pairs = _marginals(hidden @ w["out"] + w["bias"], w["moves"], w["first"])
    true = np.eye(TAGS, dtype=np.float32)[tags]
    d = (prob - true) / batch
    seen = np.zeros_like(pairs)
    np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), 1)
    g = {"moves": (pairs - seen) / batch, "first": d[0].sum(axis=0), "bias": d.sum(axis=(0, 1))}
    g["out"] = np.einsum("tbh,tbk->hk", hidden, d)
    dh = d @ w["out"].T
    g["fx"], g["fh"] = _lstm_back(dh[:, :, :HIDDEN], x, w["fx"], w["fh"], kept_f)
    g["bx"], g["bh"] = _lstm_back(dh[::-1, :, HIDDEN:], x[::-1], w["bx"], w["bh"], kept_b)
    return g


#: Steps of training at least, so that small samples are gone over more often.
LEAST_STEPS = 300


def fit(windows: np.ndarray, tags: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.02, seed: int = 7) -> Network:
    """Train on windows and tags (windows, WINDOW) with Adam; the same input gives the same network."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    steps = max(epochs * -(-len(windows) // batch), LEAST_STEPS)
    queue: list[np.ndarray] = []
    for step in range(1, steps + 1):
        if not queue:
            order = rng.permutation(len(windows))
            queue = [order[at : at + batch] for at in range(0, len(order), batch)]
        part = queue.pop()
        g = _gradient(net, windows[part].T, tags[part].T)
        size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        now = rate * (1 - 0.95 * step / steps)
        for k, v in g.items():
            v = v * min(1.0, 5.0 / max(size, 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            shift = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
            net.weights[k] = (net.weights[k] - now * shift).astype(np.float32)
    return net


def _viterbi(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags (length, batch) of scores (length, batch, TAGS)."""
    n, batch, _ = scores.shape
    best, came = first + scores[0], np.zeros(scores.shape, np.int8)
    for t in range(1, n):
        step = best[:, :, None] + moves
        came[t] = step.argmax(axis=1)
        best = step.max(axis=1) + scores[t]
    out = np.empty((n, batch), np.int8)
    out[-1] = best.argmax(axis=1)
    for t in range(n - 1, 0, -1):
        out[t - 1] = came[t][np.arange(batch), out[t]]
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Where the network reads: around digits and at signs, written out or not, as few stretches as touch."""
    out: list[list[int]] = []
    for m in WRITTEN_AT.finditer(text):
        start, end = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


#: The weight of a window's scores falls towards its ends, where it has seen less.
_TRUST = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]


def _reconciled(net: Network, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Scores of whole stretches from overlapping windows of all of them."""
    starts = [range(0, max(1, len(p) - WINDOW + STRIDE), STRIDE) for p in parts]
    windows = [np.pad(p[s : s + WINDOW], (0, max(0, WINDOW - len(p[s : s + WINDOW])))) for p, ss in zip(parts, starts) for s in ss]
    scores = [emissions(net, np.stack(windows[i : i + 2048], axis=1)) for i in range(0, len(windows), 2048)]
    made = np.concatenate(scores, axis=1).transpose(1, 0, 2) if scores else []
    out, at = [], 0
    for p, ss in zip(parts, starts):
        total, trust = np.zeros((len(p), TAGS), np.float32), np.zeros((len(p), 1), np.float32)
        for s in ss:
            n = min(WINDOW, len(p) - s)
            total[s : s + n] += made[at][:n] * _TRUST[:n]
            trust[s : s + n] += _TRUST[:n]
            at += 1
        out.append(total / trust)
    return out


#: What no reading of tags can hold: a later character of a kind behind anything but that kind.
_FORBIDDEN = np.zeros((TAGS, TAGS), np.float32)
_FORBIDDEN[:, 2::2] = -50
for _k in range(len(NAMES)):
    _FORBIDDEN[2 * _k + 1 : 2 * _k + 3, 2 * _k + 2] = 0


def _decoded(net: Network, parts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
    """(stretch, kind, start, end) of spans that the network is certain of.

    Pieces of a long stretch overlap; a span counts where it begins in the half of the overlap that is the piece's own.
    """
    pieces = []
    for j, part in enumerate(parts):
        starts = [0] if len(part) <= PIECE else range(0, len(part) - OVERLAP, PIECE - OVERLAP)
        for at in starts:
            low = at + OVERLAP // 2 if at else 0
            high = at + PIECE - OVERLAP // 2 if at + PIECE < len(part) else len(part)
            pieces.append((j, at, low, high, part[at : at + PIECE]))
    pieces.sort(key=lambda x: len(x[4]))
    first = 0
    while first < len(pieces):
        last = first + 1  # pieces of like lengths, as many as the bound on characters allows
        while last < len(pieces) and len(pieces[last][4]) <= 1.25 * len(pieces[first][4]) + 8 and (last - first + 1) * len(pieces[last][4]) <= DECODED:
            last += 1
        group, first = pieces[first:last], last
        for k, kind, start, end in _spans_of(net, [g[4] for g in group]):
            j, at, low, high, _ = group[k]
            if low <= at + start < high:
                yield j, kind, at + start, at + end


def _spans_of(net: Network, parts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
    moves, first = net.weights["moves"] + _FORBIDDEN, net.weights["first"] + _FORBIDDEN[0]
    padded = np.zeros((max(map(len, parts)), len(parts), TAGS), np.float32)
    padded[:, :, 1:] = -20  # beyond a stretch's end there is nothing
    for k, scores in enumerate(_reconciled(net, parts)):
        padded[: len(scores), k] = scores
    tags = _viterbi(padded, moves, first)
    prob, _ = _marginals(padded, moves, first)
    for k, part in enumerate(parts):
        path = tags[: len(part), k]
        for start in np.flatnonzero((path > 0) & (path % 2 == 1)):
            kind, end = (path[start] - 1) // 2, start + 1
            while end < len(path) and path[end] == path[start] + 1:
                end += 1
            if prob[np.arange(start, end), k, path[start:end]].mean() >= CERTAIN:
                yield k, int(kind), int(start), int(end)


#: Signs by which a span goes on, by kind, and how far it may.
_SIGNS = (LOCAL, *[frozenset(string.digits)] * 3, frozenset(string.ascii_letters + string.digits + "+/_-"))
LONGEST = 256


def whole_run(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """A span up to where its signs end: no address, number or secret begins or ends inside a run of them."""
    signs, low, high = _SIGNS[kind], max(0, start - LONGEST), min(len(text), end + LONGEST)
    while start < end and kind == SECRET and text[start] not in signs:
        start += 1
    while start > low and text[start - 1] in signs:
        start -= 1
    closing = _SIGNS[SECRET] | {"="} if kind == SECRET else signs - set("._%+")
    while high > end and text[end] in closing:
        end += 1
    return start, end


#: An at sign or a dot of an address, as such or written out.
_AT, _DOT = r"(?:@|[ ]?[\[(](?:at|AT)[\])][ ]?)", r"(?:\.|[ ]?[\[(](?:dot|DOT)[\])][ ]?)"
_ADDRESS = re.compile(rf"[\w.%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")


def plausible(kind: int, text: str) -> bool:
    """What a span of the network must look like besides: the checks of its kind, in other notations too."""
    if kind == 0:
        return bool(_ADDRESS.fullmatch(text))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]+([.\[\]() ]+[0-9]+){3}", text)) and valid_ip(".".join(re.findall("[0-9]+", text)))
    if kind == 2:
        return bool(re.fullmatch(r"[0-9]([ ./-]?[0-9])+", text)) and valid_card(text)
    if kind == 3:
        return bool(re.fullmatch(r"[+(]?[0-9][ ()./0-9-]+[0-9]", text)) and bool(re.search(r"[ ()./-]", text)) and valid_phone(text)
    return bool(re.fullmatch(r"[A-Za-z0-9+/_=-]{16,}", text)) and bool(re.search("[0-9]", text)) and bool(re.search("[A-Za-z]", text))


def find_all(net: Network | None, texts: list[str | None]) -> list[list[tuple[int, int, int, bool]]]:
    """Per text (start, kind, end, base) of all spans in order. Added spans touch no base span and no other."""
    base = [base_spans(t or "") for t in texts]
    found = [[(s, k, e, True) for s, k, e in spans] for spans in base]
    if net is None:
        return found
    places, parts, held = [], [], 0
    covered = [bytearray(len(t or "")) for t in texts]
    for mask, spans in zip(covered, base):
        for s, _, e in spans:
            mask[s:e] = b"\x01" * (e - s)

    def add() -> None:
        for j, kind, start, end in _decoded(net, parts):
            number, offset = places[j]
            start, end = start + offset, end + offset
            start, end = whole_run(kind, texts[number], start, end)
            if plausible(kind, texts[number][start:end]) and not any(covered[number][start:end]):
                found[number].append((start, kind, end, False))
                covered[number][start:end] = b"\x01" * (end - start)

    for number, text in enumerate(texts):
        for start, end in stretches(text) if text else ():
            places.append((number, start))
            parts.append(symbols(text[start:end]))
            held += end - start
            if held > 4 * DECODED:
                add()
                places, parts, held = [], [], 0
    add()
    return [sorted(spans) for spans in found]


# --- training windows ---------------------------------------------------------------------------------------


def shaped_spans(text: str) -> list[tuple[int, int, int]]:
    """Base spans, numbers as long as a card's (the check digit cannot be learnt, it is tested afterwards), and secrets."""
    cards = [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(_digits(m[0])) <= 19]
    secrets = [(m.start(1), SECRET, m.end(1)) for m in ASSIGNED.finditer(text) if DIGIT.search(m[1])]
    found = [x for x in set(base_spans(text)) | set(cards) if not any(s <= x[0] and x[2] <= e for s, _, e in secrets)]
    return sorted([*found, *secrets])


#: Names that a rewritten window gives a secret, and letters of it.
_TELLING = ("api_key", "API-KEY", "password", "secret", "access_key", "auth", "apikey", "client_secret")
_LETTERS = string.ascii_letters + string.digits


def _variant(kind: int, text: str, turn: int) -> str:
    """A span in another notation, so that the network learns more than the patterns."""
    digits = _digits(text)
    if kind == 2:
        mark = (" ", "-", ".", "/")[turn % 4]
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        local, mark = digits[-10:].rjust(10, "2"), (".", "-", " ", "/")[turn % 4]
        if turn % 3 == 0:
            return f"({local[:3]}) {local[3:6]}-{local[6:]}"
        if turn % 3 == 1:
            return mark.join([local[:3], local[3:6], local[6:]])
        return mark.join([f"00{local[:2]}", local[2:4], local[4:7], local[7:9], f"{local[9]}{local[0]}"])
    if kind == 0:
        name, at, domain = text.partition("@")
        middle = 1 + turn // 7 % max(1, len(name) - 1)
        text = name[:middle] + ("", ".", "_", "-")[turn // 3 % 4] + name[middle:] + at + domain
        if turn % 3 == 0:
            return text.replace(".", "_", 1).replace("a", "ä", 1)
        space, (left, right) = (" ", "")[turn % 2], ("[]", "()")[turn // 2 % 2]
        text = text.replace("@", f"{space}{left}at{right}{space}")
        return text.replace(".", f"{space}{left}dot{right}{space}") if turn % 5 < 2 else text
    if kind == SECRET:
        size, seed = 16 + turn % 33, zlib.crc32(f"{turn} {text}".encode())
        letters = _LETTERS if turn % 2 else _LETTERS[:6] + _LETTERS[-10:]
        made = []
        for _ in range(size):
            seed = (1_103_515_245 * seed + 12_345) % (1 << 31)
            made.append(letters[(seed >> 8) % len(letters)])
        return "".join(made) if DIGIT.search("".join(made)) else "7" + "".join(made)
    return (re.sub(r"\.", "[.]", text), text.replace(".", "(.)"), text.replace(".", " . "), text)[turn % 4]


def _renamed(before: str, turn: int) -> str:
    """The text before a secret with another name and sign of assignment."""
    name = re.search(r"""[\w-]+["']?\s*[:=]\s*["']?$""", before)
    if not name:
        return before
    return before[: name.start()] + _TELLING[turn % len(_TELLING)] + (" = ", "=", ": ", '="', "='", ' = "')[turn // 3 % 6]


def training_windows(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[bytes, bytes]]:
    """Windows around a text's stretches with the tags of its base spans, and with one span rewritten."""
    for start, end in stretches(text):
        inside = [(s, k, e) for s, k, e in spans if start <= s and e <= end]
        versions = [(text[start:end], [(s - start, k, e - start) for s, k, e in inside])]
        for s, k, e in inside[:3]:
            for turn in range(5):
                turn = zlib.crc32(f"{turn} {text[s:e]}".encode()) >> 4  # the notation is the span's, not its place's
                new = _variant(k, text[s:e], turn)
                before = _renamed(text[start:s], turn) if k == SECRET else text[start:s]
                versions.append((before + new + text[e:end], [(len(before), k, len(before) + len(new))]))
        for part, marked in versions:
            tags = np.zeros(len(part), np.uint8)
            for s, k, e in sorted(marked, key=lambda x: (x[1] == 2, x[0])):  # a card inside a phone number is the phone's
                if s < len(tags) and not tags[s:e].any():
                    tags[s:e] = 2 * k + 2
                    tags[s] = 2 * k + 1
            signs = symbols(part)
            # besides the windows as they are read, some that begin elsewhere, so that no place is learnt
            shift = zlib.crc32(part.encode())
            starts = {*range(0, max(1, len(part) - WINDOW + STRIDE), STRIDE), shift % MARGIN, shift // MARGIN % MARGIN}
            for at in sorted(a for a in starts if a < len(part)):
                pad = (0, max(0, WINDOW - (len(part) - at)))
                yield np.pad(signs[at : at + WINDOW], pad).tobytes(), np.pad(tags[at : at + WINDOW], pad).tobytes()


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> Network | None:
    """A network for the corpus, or None if no window of the sample has a span."""
    sample = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id").alias("h"), "doc_id")
    ids = sample.distinct().orderBy("h", "doc_id").limit(sample_docs).select("doc_id")
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most sample_docs rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            made = [w for t in batch.column(1).to_pylist() if t for w in training_windows(t, shaped_spans(t))]
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.binary()) for i in (0, 1)], ["signs", "tags"])

    windows = texts.mapInArrow(work, "signs binary, tags binary").distinct()
    marked = F.regexp_replace(F.hex("tags"), "0", "") != ""
    turn = F.xxhash64("signs", "tags")
    windows = stored(windows)
    rows = windows.filter(~marked).orderBy(turn).limit(sample_windows // 2).collect()  # half of the windows at most hold no span
    found = windows.filter(marked).orderBy(turn).limit(sample_windows - len(rows)).collect()
    if not found:
        return None
    rows += found
    signs, tags = (np.stack([np.frombuffer(bytes(r[i]), np.uint8) for r in rows]) for i in (0, 1))
    return fit(signs, tags)


def find(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``found``: all spans of the whole text as (kind, start, end, base), in order, in code points.

    Null and empty texts have none; rows with equal keys are searched each. Base spans may overlap if their kinds differ;
    spans at one place come in the order of the kinds, and an added span gives way to any other. Other columns are not
    read. One narrow stage; the network has a few thousand parameters, and what it holds at a time is bounded.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for batch in chunks(batches):
            found = find_all(net, batch.column(1).to_pylist())
            lists = [[{"kind": NAMES[k], "start": s, "end": e, "base": b} for s, k, e, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(row))], ["k", "found"])

    ddl = f"k {kind}, found array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
    return small_batches(docs).select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(work, ddl).withColumnRenamed("k", key)
