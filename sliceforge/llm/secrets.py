"""Secret scans: a character convolutional network over every candidate and its surroundings.

Candidates come from patterns (key assignments, access keys, hexadecimal strings), from every other unbroken
run of key characters, with digits or without, and from what follows a word for a credential. The network reads
all characters of a candidate, in overlapping blocks, and those on both sides of it: an embedding for each
character class, filters of two widths, max pooling separately over the candidate and over its context, and a
linear layer. It is trained in numpy on labelled findings, and each kind has its own threshold: the highest one
that still finds the wanted share of the findings held back for calibration (recall comes first).

Every candidate gets its score and the verdict of its kind's threshold. The three base kinds are reported
whatever the verdict, as the contract asks; the network alone decides on the others (kind `extra`).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.textkit import column, portions, rows
from sliceforge.runtime import ship, table

#: The base patterns, with the least length of what they must catch, in the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "extra")

#: Other candidates: unbroken runs of key characters, and shorter ones after a word for a credential.
_LONG = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}")
_AFTER = re.compile(
    r"""\b(?:password|passwd|passphrase|pwd|pin|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|bearer|auth)\b["']?(?:\x20+is|\x20+was)?\x20*[:=]?\x20*["']?([A-Za-z0-9+/_=.~!@#$%^&*-]{6,})""",
    re.I | re.A,
)
_AFTER_HINT = re.compile(r"pass|pwd|pin|secret|token|key|cred|bearer|auth", re.I | re.A)
#: A maximal run of 24 or more is the same as a match of the hex pattern that is long enough.
_HEX_LONG = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
_ASSIGN_HINT = re.compile(r"passw|secret|token|api", re.I | re.A)

CONTEXT = 24
BODY = 64
DIM = 6
FILTERS = 10
WIDTHS = (3, 5)
RECALL = 0.98


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base findings, by start, then in the order of the kinds."""
    out = []
    if _ASSIGN_HINT.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [("hex", m.start(), m.end()) for m in _HEX_LONG.finditer(text)]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def other_candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Runs of key characters outside the base findings, by start; none overlaps another."""
    met = [m.span() for m in _LONG.finditer(text)]
    if _AFTER_HINT.search(text):
        met += [m.span(1) for m in _AFTER.finditer(text)]
    out, taken = [], [(s, e) for _, s, e in base]
    for s, e in sorted(met, key=lambda x: (x[0], -x[1])):
        while e > s and text[e - 1] in ".=-":  # the end of a sentence is no part of a key
            e -= 1
        if e - s >= 6 and not any(a < e and s < z for a, z in taken):
            out.append(("extra", s, e))
            taken.append((s, e))
    return out


def _classes() -> np.ndarray:
    """Character classes: each letter without case, case and digits apart, punctuation by itself, the rest together."""
    t = np.full(256, 95, np.int64)
    for c in range(32, 127):
        t[c] = c - 32
    return t


_CLASS = _classes()
N_CLASS = 97
PAD = 96


def _blocks(text: str, start: int, end: int) -> list[str]:
    """A candidate in blocks that overlap by the widest filter less one, so that no place of a filter is lost."""
    step = BODY - max(WIDTHS) + 1
    return [text[at : min(end, at + BODY)].ljust(BODY, "\0") for at in range(start, max(start + 1, end - max(WIDTHS) + 1), step)]


def _codes(parts: list[str], width: int) -> np.ndarray:
    raw = np.frombuffer("".join(parts).encode("latin-1", "replace"), np.uint8).reshape(len(parts), width)
    return np.where(raw == 0, PAD, _CLASS[raw])


def code(items: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the blocks of each candidate, of its context, and the first block of each."""
    blocks, near, first = [], [], []
    for text, s, e in items:
        first.append(len(blocks))
        blocks += _blocks(text, s, e)
        near.append(text[max(0, s - CONTEXT) : s].rjust(CONTEXT, "\0") + "\0" + text[e : e + CONTEXT].ljust(CONTEXT, "\0"))
    return _codes(blocks, BODY), _codes(near, 2 * CONTEXT + 1), np.array(first, np.int64)


@dataclass
class Net:
    emb: np.ndarray
    filters: list[np.ndarray]
    out: np.ndarray
    bias: float
    cuts: dict[str, float]

    def pooled(self, parts: tuple[np.ndarray, np.ndarray], first: np.ndarray, places: bool = False):
        """Max-pooled activations of each candidate; with places (one block each) where each was reached."""
        tops, where = [], []
        for p, codes in enumerate(parts):
            x = self.emb[codes]
            for j, w in enumerate(WIDTHS):
                win = np.lib.stride_tricks.sliding_window_view(x, w, axis=1).transpose(0, 1, 3, 2).reshape(len(x), -1, w * DIM)
                act = win @ self.filters[p * len(WIDTHS) + j]
                at = act.argmax(axis=1)
                top = np.maximum(np.take_along_axis(act, at[:, None], 1)[:, 0], 0)
                tops.append(np.maximum.reduceat(top, first, axis=0) if p == 0 else top)
                where.append(at)
        pooled = np.concatenate(tops, axis=1)
        return (pooled, where) if places else pooled

    def score(self, items: list[tuple[str, int, int]]) -> np.ndarray:
        if not items:
            return np.zeros(0)
        out = []
        for lo in range(0, len(items), 2048):
            body, near, first = code(items[lo : lo + 2048])
            z = self.pooled((body, near), first) @ self.out + self.bias
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return np.concatenate(out)


_SYLLABLES = "an ber con de el for gen ha in ka lung men nis or per qui rea schaft sta ter tion un ver wir zo".split()
_KEY_NAMES = "password secret token api_key apikey passwd".split()


def labelled_findings(n: int = 6000, seed: int = 11) -> tuple[list[tuple[str, int, int]], np.ndarray, list[str]]:
    """Labelled findings to train on, drawn from a rule: keys of several shapes and card numbers in settings and prose, against
    long words, identifiers, paths, addresses, dates, numbers and rules of signs in like places."""
    rng = np.random.default_rng(seed)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alnum = upper + lower + digits
    words = "user build release page image north table report index volume chapter data order field server nicht dans para which their".split()

    def chars(alphabet: str, lo: int, hi: int) -> str:
        return "".join(rng.choice(list(alphabet), int(rng.integers(lo, hi))))

    def one(values):
        return values[int(rng.integers(len(values)))]

    def long_word() -> str:
        out = "".join(one(_SYLLABLES) for _ in range(int(rng.integers(5, 12))))
        return out.capitalize() if rng.random() < 0.3 else out

    def prose() -> str:
        return " ".join(one(words) for _ in range(int(rng.integers(3, 9))))

    def key() -> tuple[str, str, str, int]:
        sep = one(["=", ": ", " = ", ":"])
        pick = int(rng.integers(7))
        if pick == 6:  # numbers of payment cards
            return "", chars(digits, 16, 17), "extra", 1
        if pick == 0:
            return "", f"{one(_KEY_NAMES)}{sep}{one(['', chr(34)])}{chars(one([alnum, digits + 'abcdef', alnum + '+/', lower + digits]), 8, 44)}", "assign", 1
        if pick == 1:
            return "", "AKIA" + chars(upper + digits, 16, 17), "access", 1
        if pick == 2:
            return f"{one(_KEY_NAMES)}{sep}" if rng.random() < 0.5 else "", chars("0123456789abcdef", 32, 60), "hex", 1
        if pick == 3:
            return one(["bearer ", "key ", "auth ", "credential ", "", "token "]), chars(alnum + "+/_-", 20, 60), "extra", 1
        if pick == 4:
            return one(["password is ", "passphrase: ", "pwd ", "pin = ", "Password is "]), chars(alnum + "!@#$%^&*", 8, 20), "extra", 1
        return one(["", "id ", "key "]), "-".join(chars("0123456789abcdefABCDEF", 4, 13) for _ in range(int(rng.integers(3, 5)))), "extra", 1

    def harmless() -> tuple[str, str, str, int]:
        pick = int(rng.integers(11))
        if pick == 10:
            return one(["", "no. ", "isbn "]), chars("01", 16, 40) if rng.random() < 0.5 else one(["00000000", "20", "1.2.", "10-"]) + chars(digits, 18, 40), "extra", 0
        if pick == 0:
            return "", f"{one(_KEY_NAMES)}{one(['=', ': ', ' = '])}{one(['', chr(34)])}{one([one(words) + one(words), long_word(), 'x' * int(rng.integers(6, 20))])}", "assign", 0
        if pick == 1:
            return "", "-".join([one(words), one(words), str(int(rng.integers(1, 3000))), one(words)]), "extra", 0
        if pick == 2:
            return "", "/".join([one(words), one(words), str(int(rng.integers(1990, 2030))), one(words), one(words)]), "extra", 0
        if pick == 3:
            return "", chars("0", 24, 40) if rng.random() < 0.5 else "abc" * 10, "hex", 0
        if pick == 4:
            return one(["", "password ", "token ", "secret ", "Password is "]), (long_word() + long_word())[: int(rng.integers(16, 50))], "extra", 0
        if pick == 5:
            return one(["", "at ", "www."]), ".".join([one(words), one(words), one(["com", "org", "html"])]) + "/" + one(words), "extra", 0
        if pick == 6:
            return "", one(["-", "=", "_", "."]) * int(rng.integers(16, 60)), "extra", 0
        if pick == 7:
            return one(["password ", "the token ", "a secret ", "password is ", "auth "]), one(["required", "between", "therefore", "another", "changes", "nothing", "without"]), "extra", 0
        if pick == 8:
            return "", "_".join(one(words) for _ in range(int(rng.integers(3, 6)))), "extra", 0
        return "", f"{int(rng.integers(1990, 2030))}-{int(rng.integers(10, 13))}-{int(rng.integers(10, 29))}T{int(rng.integers(10, 24))}.{int(rng.integers(10, 60))}.00", "extra", 0

    items, labels, kinds = [], [], []
    while len(items) < n:
        lead, body, kind, y = key() if rng.random() < 0.5 else harmless()
        before, body = f"{prose()} {lead}", body[:BODY]
        items.append((f"{before}{body}{one([' ', '. ', ', ', chr(10), chr(34) + ' '])}{prose()}", len(before), len(before) + len(body)))
        labels.append(y)
        kinds.append(kind)
    return items, np.array(labels, np.float32), kinds


def train(items, labels: np.ndarray, kinds: list[str], epochs: int = 8, recall: float = RECALL, seed: int = 3) -> Net:
    """Mini-batch Adam; three quarters of the findings are fitted on, the rest set the thresholds."""
    rng = np.random.default_rng(seed)
    *parts, first = code(items)
    if len(parts[0]) != len(items):
        raise ValueError("findings to train on must fit one block")
    net = Net(
        rng.normal(0, 0.3, (N_CLASS, DIM)),
        [rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS)) for _ in parts for w in WIDTHS],
        rng.normal(0, 0.2, len(parts) * len(WIDTHS) * FILTERS),
        0.0,
        dict.fromkeys(KINDS, 0.5),
    )
    order = rng.permutation(len(items))
    fit_on, check_on = order[: len(order) * 3 // 4], order[len(order) * 3 // 4 :]
    state: dict[str, list[np.ndarray]] = {}
    t = 0

    def adam(name: str, v: np.ndarray, g: np.ndarray) -> None:
        a, b = state.setdefault(name, [np.zeros_like(v), np.zeros_like(v)])
        a += 0.1 * (g - a)
        b += 0.01 * (g * g - b)
        v -= 0.02 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)

    for _ in range(epochs):
        rng.shuffle(fit_on)
        for lo in range(0, len(fit_on), 64):
            pick = fit_on[lo : lo + 64]
            t += 1
            sub = tuple(p[pick] for p in parts)
            pooled, where = net.pooled(sub, np.arange(len(pick)), True)
            err = (1 / (1 + np.exp(-np.clip(pooled @ net.out + net.bias, -30, 30))) - labels[pick]) / len(pick)
            back = err[:, None] * net.out * (pooled > 0)
            grad_emb = np.zeros_like(net.emb)
            grads = []
            for k, at in enumerate(where):
                p, w = k // len(WIDTHS), WIDTHS[k % len(WIDTHS)]
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                spot = at[:, :, None] + np.arange(w)
                codes = sub[p][np.arange(len(pick))[:, None, None], spot]  # (texts, filters, width)
                seen = net.emb[codes]
                grads.append(np.einsum("nf,nfwd->wdf", g, seen).reshape(w * DIM, FILTERS))
                pull = np.einsum("nf,wdf->nfwd", g, net.filters[k].reshape(w, DIM, FILTERS))
                np.add.at(grad_emb, codes.reshape(-1), pull.reshape(-1, DIM))
            adam("out", net.out, pooled.T @ err)
            net.bias -= 0.05 * float(err.sum())
            for k, g in enumerate(grads):
                adam(f"f{k}", net.filters[k], g)
            adam("emb", net.emb, grad_emb)
    scores = net.score([items[i] for i in check_on])
    truth, names = labels[check_on], np.array([kinds[i] for i in check_on])
    for kind in KINDS:
        found = np.sort(scores[(names == kind) & (truth == 1)])
        if len(found):
            net.cuts[kind] = float(found[int((1 - recall) * len(found))])
    return net


#: What a scan tells of each candidate.
SPAN = "kind:string,start:int,end:int,score:double,confirmed:boolean"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("confirmed", pa.bool_())]))


def scan(docs: DataFrame, net: Net, text: str = "text") -> DataFrame:
    """docs -> doc_id, spans array<struct<kind, start, end, score, confirmed>>, a row for a row.

    Offsets count code points, ends are exclusive; spans come by start, then in the order of the kinds.
    All base findings are there, confirmed by the network or not, and other candidates that it confirms.
    Null and empty texts have no spans; repeated rows are scanned alike; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(net)  # size fixed by the classes, filters and widths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches):
            yield rows(doc_id=column(b, "doc_id"), spans=pa.array(find_all(texts, held.value), _SPANS))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id long, spans array<struct<{SPAN}>>")


def find_all(texts, net: Net) -> list[list[dict]]:
    found, items = [], []
    for t in texts:
        t = t if isinstance(t, str) else ""
        base = base_spans(t)
        spans = base + other_candidates(t, base)
        found.append(spans)
        items += [(t, s, e) for _, s, e in spans]
    scores = iter(net.score(items).tolist())
    out = []
    for spans in found:
        told = []
        for k, s, e in spans:
            z = next(scores)
            if k != "extra" or z >= net.cuts[k]:
                told.append({"kind": k, "start": s, "end": e, "score": z, "confirmed": z >= net.cuts[k]})
        out.append(sorted(told, key=lambda r: (r["start"], KINDS.index(r["kind"]))))
    return out


def written(spans) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def _net() -> Net:
    return train(*labelled_findings())


def op4(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, then n_extra and n_confirmed (spans that the network confirms, of any kind)."""
    ship(spark)
    held = spark.sparkContext.broadcast(_net())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches):
            found = find_all(texts, held.value)
            base = [[s for s in f if s["kind"] != "extra"] for f in found]
            count = {f"n_{k}": pa.array([sum(s["kind"] == k for s in f) for f in found], pa.int64()) for k in KINDS}
            extra = count.pop("n_extra")
            yield rows(
                doc_id=column(b, "doc_id"),
                **count,
                base_sha256=pa.array([hashlib.sha256(written(f).encode()).hexdigest() for f in base], pa.string()),
                spans=pa.array([written(f) for f in found], pa.string()),
                n_extra=extra,
                n_confirmed=pa.array([sum(s["confirmed"] for s in f) for f in found], pa.int64()),
            )

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_extra long, n_confirmed long")


def redact(text: str, spans) -> str:
    """The text with every span replaced by its kind; overlapping spans go together."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind']}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redact_stage(docs: DataFrame) -> DataFrame:
    """The pipeline stage: secrets are replaced in the texts; all documents stay, null texts stay null."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(_net())

    # Arrow batches keep every other column as it is, whole numbers beside nulls included
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches):
            at = b.schema.get_field_index("text")
            field = b.schema.field(at)
            found = find_all(texts, held.value)
            yield b.set_column(at, field, pa.array([redact(t, s) if s else t for t, s in zip(texts, found, strict=True)], field.type))

    return docs.mapInArrow(run, docs.schema)
