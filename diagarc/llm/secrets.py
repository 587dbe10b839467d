"""Secret scans: exact patterns, and a small convolutional network over every other candidate.

Runs of token characters are candidates. The patterns' findings always stand. Each candidate that
they leave, and what they leave of one, is shown to a character network together with the text
around it, a long one in overlapping windows of which the highest counts; it adds a finding where
the calibrated probability reaches a threshold. The network is trained on labelled
findings: a bounded sample of the corpus's own candidates, labelled by the patterns, and
generated ones of kinds that the patterns do not name. Its threshold is the largest that still
finds the asked share of held-out labelled secrets.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from diagarc.llm.common import map_batches, table

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
RUN_LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{RUN_LEAST},}}")
#: Characters shown before a candidate, of it, and after it.
BEFORE, INSIDE, AFTER = 24, 48, 12
WIDTH = BEFORE + INSIDE + AFTER
#: Longer candidates are shown in windows that begin so far apart; so many windows are held at once.
SLIDE, SHOWN = 16, 4096
#: The bound of the training sample: documents that are scanned, findings that are kept, findings that are generated.
SAMPLE_DOCS, SAMPLE_FINDINGS, GENERATED = 4000, 2000, 1600


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of the patterns' findings, by start and kind, and all runs of 16 or more token characters.

    The other two patterns can only match inside such a run, so they look nowhere else.
    """
    spans = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    runs = [m.span() for m in RUN.finditer(text)]
    for begin, end in runs:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, begin, end) if m.end() - m.start() >= 20]
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text, begin, end)]
    return sorted(spans), runs


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def window(text: str, begin: int, end: int) -> bytes:
    """A candidate with its surroundings at fixed places; 0 where there is no text, 127 for other alphabets."""
    before = text[max(0, begin - BEFORE) : begin].rjust(BEFORE, "\0")
    inside = text[begin : min(end, begin + INSIDE)].ljust(INSIDE, "\0")
    after = text[end : end + AFTER].ljust(AFTER, "\0")
    return (before + inside + after).translate(_Other()).encode("ascii", "replace")


class _Other(dict):
    def __missing__(self, code):
        return code if code < 128 else 127


def windows(text: str, begin: int, end: int) -> list[tuple[int, bytes]]:
    """Where each window on a candidate begins, and what it shows."""
    starts = [*range(begin, end - INSIDE, SLIDE), end - INSIDE] if end - begin > INSIDE else [begin]
    return [(at, window(text, at, min(end, at + INSIDE))) for at in starts]


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Pattern findings; runs that hold none of them; and of the others what they leave, if long enough for a run."""
    spans, runs = base_spans(text)
    free, left = [], []
    for begin, end in runs:
        met = [(s, e) for s, _, e in spans if s < end and begin < e]
        if not met:
            free.append((begin, end))
            continue
        at = begin
        for s, e in [*met, (end, end)]:
            if s - at >= RUN_LEAST:
                left.append((at, s))
            at = max(at, e)
    return spans, free, left


def labelled(text: str) -> list[tuple[bytes, int]]:
    """What the network may learn from a text: runs without findings, and windows on others that show much of a finding."""
    spans, free, _ = candidates(text)
    out = [(seen, 0) for a, b in free for _, seen in windows(text, a, b)]
    for a, b in {r.span() for r in RUN.finditer(text)}.difference(free):
        shows = lambda at: max(min(e, b, at + INSIDE) - max(s, at) for s, _, e in spans)  # noqa: E731, B023
        out += [(seen, 1) for at, seen in windows(text, a, b) if b - a <= INSIDE or shows(at) >= RUN_LEAST]
    return out


def generated(n: int, seed: int = 11) -> list[tuple[bytes, int]]:
    """Labelled findings by rule: keys of several alphabets in several settings, also late in a long run; numbers, dates, paths and long names."""
    rng = np.random.default_rng(seed)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    pick = lambda alphabet, k: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), k))
    word = lambda: pick("etaoinshrdlucm", int(rng.integers(2, 9)))
    number = lambda k: pick(digits, k)
    both = letters + letters.upper()
    onset = "b c d f g h k l m n p r s t v w z j qu x y st sch ch th tr pl br ph gr".split()
    coda = "n r s t l m d ng st ck rt y nd tz pf".split() + [""] * 12
    name = lambda k: "".join(onset[rng.integers(0, len(onset))] + "aeiouaeioue"[rng.integers(0, 11)] + coda[rng.integers(0, len(coda))] for _ in range(k))
    some = lambda: name(int(rng.integers(1, 4)))
    path = lambda: "/".join(some() for _ in range(int(rng.integers(6, 16)))) + "/" * int(rng.integers(0, 2))
    out = []
    for i in range(n):
        size = int(rng.integers(18, 56))
        if i % 2:
            key = [lambda: pick(letters + letters.upper() + digits, size), lambda: pick(letters + letters.upper() + digits + "+/", size) + "=",
                   lambda: pick(digits + "ABCDEF", size), lambda: "sk_live_" + pick(letters + digits, size), lambda: "ghp_" + pick(letters + letters.upper() + digits, 36),
                   lambda: "eyJ" + pick(letters + letters.upper() + digits + "_-", size), lambda: pick(both, int(rng.integers(16, 24))), lambda: pick(both + digits, int(rng.integers(16, 24)))][i // 2 % 8]()
        else:
            key = [lambda: number(16), lambda: f"20{number(2)}-{number(2)}-{number(2)}T{number(2)}-{number(2)}-{number(2)}", lambda: f"/{word()}/{word()}{number(1)}/{word()}-{word()}",
                   lambda: f"{word()}-{number(2)}-{word()}-{number(3)}-{word()}", lambda: f"{word()}{word()}{word()}{word()}{number(1)}", lambda: f"{number(4)}-{number(4)}-{number(4)}-{number(4)}",
                   lambda: f"{word()}_{word()}_{word()}_{number(4)}", lambda: "=" * 10 + number(2) + "-" * 10,
                   lambda: (word() * 3 + name(5)).ljust(16, "e")[:28], lambda: name(6).ljust(16, "e"), lambda: name(6).capitalize().ljust(16, "e"), lambda: name(7).upper().ljust(16, "E"),
                   lambda: "".join(some().capitalize() for _ in range(6)).ljust(16, "e"), path, lambda: "/" + path(), lambda: "=-_"[i // 2 % 3] * size][i // 2 % 16]()
        lead = [f"{word()} {word()} ", f"{word()}: ", f'{word()} = "', f"Authorization: Bearer ", f"\n{word()} {word()}, ", f"({word()} "][int(rng.integers(0, 6))]
        ahead = f"{path()}{'/-_='[i // 2 % 4]}" if i % 8 == 1 else ""
        text = f"{word()} {word()} {lead}{ahead}{key} {word()}. {word()}"
        at = text.index(ahead + key)
        begin, end = at + len(ahead), at + len(ahead) + len(key)
        seen = windows(text, at, end)
        # The window that shows most of the key, or any of those on no key.
        seen = max(seen, key=lambda w: min(end, w[0] + INSIDE) - max(begin, w[0])) if i % 2 else seen[int(rng.integers(0, len(seen)))]
        out.append((seen[1], i % 2))
    return out


class Network:
    """Character embedding, one convolution, the largest response inside and outside the candidate, and a logistic output."""

    def __init__(self, seed: int = 5, channels: int = 8, filters: int = 24, reach: int = 5):
        rng = np.random.default_rng(seed)
        self.reach = reach
        self.inside = np.zeros(WIDTH - reach + 1, bool)
        self.inside[BEFORE - reach // 2 : BEFORE + INSIDE - reach // 2] = True
        self.parts = [rng.normal(0, 0.3, (128, channels)), rng.normal(0, (reach * channels) ** -0.5, (reach * channels, filters)),
                      np.zeros(filters), rng.normal(0, 0.1, 2 * filters), np.zeros(1)]
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, codes):
        embed, conv, bias, out, last = self.parts
        x = embed[codes]
        n = codes.shape[1] - self.reach + 1
        rows = np.concatenate([x[:, i : i + n] for i in range(self.reach)], axis=2)
        h = rows @ conv + bias
        pools, places = [], []
        for part in (np.flatnonzero(self.inside), np.flatnonzero(~self.inside)):
            best = h[:, part].argmax(1)
            places.append(part[best])
            pools.append(np.take_along_axis(h, part[best][:, None, :], 1)[:, 0])
        pooled = np.concatenate(pools, axis=1)
        active = np.maximum(pooled, 0)
        return active @ out + last[0], rows, places, pooled, active

    def probability(self, windows: list[bytes]) -> np.ndarray:
        """Calibrated probability that each window shows a secret."""
        out = [np.zeros(0)]
        for at in range(0, len(windows), 512):
            codes = np.frombuffer(b"".join(windows[at : at + 512]), np.uint8).reshape(-1, WIDTH)
            out.append(1 / (1 + np.exp(-np.clip(self.scale * self._forward(codes)[0] + self.shift, -40, 40))))
        return np.concatenate(out)

    def train(self, windows: list[bytes], labels: list[int], recall: float, epochs: int = 10, batch: int = 64, rate: float = 0.01, seed: int = 3):
        rng = np.random.default_rng(seed)
        codes, truth = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH), np.array(labels, float)
        mixed = rng.permutation(len(truth))
        kept, checked = mixed[len(mixed) // 4 :], mixed[: len(mixed) // 4]
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in self.parts]
        count = 0
        for _ in range(epochs):
            for at in range(0, len(kept), batch):
                own = kept[at : at + batch]
                logit, rows, places, pooled, active = self._forward(codes[own])
                slope = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - truth[own]) / len(own)
                back = slope[:, None] * self.parts[3] * (pooled > 0)
                f = len(self.parts[2])
                d_conv, d_embed = np.zeros_like(self.parts[1]), np.zeros_like(self.parts[0])
                i, j = np.arange(len(own))[:, None], np.arange(f)[None]
                for half, place in enumerate(places):
                    b = back[:, half * f : (half + 1) * f]
                    seen = rows[i, place]
                    d_conv += np.einsum("nfd,nf->df", seen, b)
                    to_rows = b[:, :, None] * self.parts[1].T[None]
                    for k in range(self.reach):
                        c = self.parts[0].shape[1]
                        np.add.at(d_embed, codes[own][i, place + k], to_rows[:, :, k * c : (k + 1) * c])
                slopes = [d_embed, d_conv, back[:, :f].sum(0) + back[:, f:].sum(0), active.T @ slope, np.array([slope.sum()])]
                count += 1
                for p, g, (m, v) in zip(self.parts, slopes, moments):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-8)
        logit = self._forward(codes[checked])[0]
        self._calibrate(logit, truth[checked])
        self.threshold = self._threshold(1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -40, 40))), truth[checked], recall)
        return self

    def _calibrate(self, logit, truth):
        """A logistic line through held-out scores, with smoothed targets."""
        high, low = (truth.sum() + 1) / (truth.sum() + 2), 1 / ((1 - truth).sum() + 2)
        target = np.where(truth > 0, high, low)
        a, b = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * logit + b, -40, 40)))
            w = p * (1 - p) + 1e-6
            g = np.array([((p - target) * logit).sum(), (p - target).sum()])
            h = np.array([[(w * logit * logit).sum() + 1e-3, (w * logit).sum()], [(w * logit).sum(), w.sum() + 1e-3]])
            move = np.linalg.solve(h, g)
            a, b = a - 0.5 * move[0], b - 0.5 * move[1]
        self.scale, self.shift = a, b

    @staticmethod
    def _threshold(probability, truth, recall):
        """The largest threshold that finds the asked share of true secrets."""
        found = np.sort(probability[truth > 0])
        return float(found[int((1 - recall) * len(found))]) if len(found) else 1.0


def fit(docs: DataFrame, recall: float = 0.97, sample_docs: int = SAMPLE_DOCS, sample_findings: int = SAMPLE_FINDINGS) -> Network:
    """The network for these documents; what it learns from is bounded by the two sample sizes."""
    n = docs.select("doc_id").count()
    own = docs.select("text", F.xxhash64("doc_id").alias("h")).filter(F.pmod(F.xxhash64("h"), F.lit(max(1, n // sample_docs))) == 0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [f for t in batch.column(0).to_pylist() if t for f in labelled(t)]
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int32())], ["seen", "label"])

    rows = map_batches(own, run, "seen binary, label int").orderBy(F.xxhash64("seen"), "label").limit(sample_findings).collect()
    known = [(bytes(r.seen), r.label) for r in rows] + generated(GENERATED)
    return Network().train([w for w, _ in known], [y for _, y in known], recall)


_networks: dict[str, Network] = {}


def scan(docs: DataFrame, network: Network) -> DataFrame:
    """All columns of ``docs`` and ``findings``: array of (kind, begin, end) by begin, kinds as listed in KINDS.

    A null text has none. Positions are code points, ends exclusive. No shuffle.
    """
    held, key = docs.sparkSession.sparkContext.broadcast(network), uuid.uuid4().hex
    names = [c for c in docs.columns if c != "findings"]
    struct = pa.struct([("kind", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _networks:
            _networks.clear()
            _networks[key] = held.value
        own, found, shown, hits = _networks[key], [], [], set()

        def judge():
            hits.update(s[0] for s, p in zip(shown, own.probability([s[1] for s in shown])) if p >= own.threshold)
            shown.clear()

        for i, text in enumerate(batch.column(names.index("text"))):
            text = text.as_py() or ""
            spans, free, left = candidates(text)
            found.append(spans)
            for a, b in free + left:
                shown += [((i, a, b), seen) for _, seen in windows(text, a, b)]
                if len(shown) >= SHOWN:
                    judge()
        judge()
        for i, a, b in hits:
            found[i].append((a, 3, b))
        lists = [[{"kind": k, "begin": a, "end": b} for a, k, b in sorted(spans)] for spans in found]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(struct))], [*names, "findings"])

    rows = docs.select(*names)
    findings = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    return map_batches(rows, run, T.StructType([*rows.schema, T.StructField("findings", findings)]))


def redacted(docs: DataFrame, network: Network, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every finding's text replaced by ``mark`` (overlapping findings by one), and n_chars renewed if present.

    All other columns, of whatever name, stay as they are.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    found = scan(own, network)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if spans:
                at, parts = 0, []
                for span in spans:
                    if span["end"] > at:
                        parts += [] if span["begin"] < at else [text[at : span["begin"]], mark]
                        at = span["end"]
                text = "".join([*parts, text[at:]])
            texts.append(text)
        changed = [bool(spans) for spans in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(changed, pa.bool_())], ["row", "text", "changed"])

    out = map_batches(found.select("row", "text", "findings"), run, T.StructType([*own.schema, T.StructField("changed", T.BooleanType())]))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op3_secrets(spark, directory):
    docs = table(spark, directory, "documents")
    found = scan(docs.select("doc_id", "text"), fit(docs)).drop("text")
    kinds = F.array(*map(F.lit, KINDS))
    line = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", F.get(kinds, f["kind"]), f["begin"], f["end"])), ",")
    of = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("bigint")
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), of(3).alias("n_model"),
                        F.sha2(line(F.filter("findings", lambda f: f["kind"] < 3)), 256).alias("base_sha256"), line(F.col("findings")).alias("spans"))
