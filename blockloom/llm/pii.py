"""Personal data: exact base patterns, and further spans by weak supervision.

Regex, gazetteer and context labelers vote on candidate spans; expectation-maximisation over the counts of vote
patterns (a bounded table, counted over all documents) estimates how reliable each labeler is; a logistic classifier on
the votes and the shape of the span and its surroundings, trained on those estimates, decides which candidates become
spans. Base spans are always kept."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import map_batches, materialize

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Matches hang on their one @: the run before it is taken back to the last match's end, in linear time."""
    out, free, at = [], 0, t.find("@")
    while at >= 0:
        start = free + len(t[free:at].rstrip(_LOCAL))
        if start < at and (m := _DOMAIN.match(t, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = t.find("@", free)
    return out


def base_spans(t: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping spans of each kind, in code points."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in t:
        out["email"] = emails(t)
    if not _DIGIT.search(t):
        return out
    out["ip"] = [m.span() for m in _IP.finditer(t) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(t):
        if 16 <= m.end() - m.start() <= 37 and 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


# Candidate shapes beyond the base patterns, and the gazetteers of words that go with each kind.
SHAPES = {
    "secret": r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "national_phone": r"(?<![0-9+(])(?:\+[0-9]{1,3} ?)?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9-])|(?<![0-9+(-])[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![0-9-])",
    "spelled_email": r"(?<![A-Za-z0-9])[A-Za-z0-9._-]{2,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{2,63} ?[\[(]dot[\])] ?[A-Za-z]{2,10}(?![A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "grouped_card": r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
}
# Words in English, German, French and Spanish.
GAZETTEER = {
    "secret": (
        "access", "api", "apikey", "auth", "authorization", "bearer", "clave", "cle", "clé", "contraseña", "credential", "credentials",
        "geheimnis", "key", "kennwort", "passphrase", "passwd", "password", "passwort", "private", "pwd", "schlüssel", "secret", "secreto",
        "session", "signature", "token", "jeton", "zugang",
    ),
    "ssn": ("ssn", "social", "security", "tax", "taxpayer", "tin", "itin", "steuernummer", "sozialversicherung", "sécurité", "sociale", "seguro", "seguridad"),
    "national_phone": (
        "anruf", "anrufen", "appel", "appelez", "call", "cell", "cellphone", "contact", "contacto", "dial", "fax", "handy", "kontakt", "llame",
        "mobil", "mobile", "móvil", "phone", "portable", "reach", "rufen", "rufnummer", "sms", "tel", "telefon", "teléfono", "telefax",
        "telephone", "telefono", "text", "téléphone", "whatsapp",
    ),
    "spelled_email": ("adresse", "contact", "contacto", "correo", "courriel", "e-mail", "email", "escriba", "kontakt", "mail", "reach", "schreiben", "write", "écrire"),
    "iban": ("account", "bank", "banco", "banque", "bankverbindung", "bic", "compte", "cuenta", "iban", "konto", "kontonummer", "swift", "transfer", "virement"),
    "grouped_card": ("amex", "card", "carte", "credit", "crédit", "crédito", "debit", "karte", "kreditkarte", "mastercard", "payment", "tarjeta", "visa", "zahlung"),
}
ADDED = tuple(SHAPES)
_SHAPE = {k: re.compile(v) for k, v in SHAPES.items()}
_CONTEXT = re.compile(r"[:=]\s?[\"']?$")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
LABELERS = ("regex", "gazetteer", "context", "variety", "alone")
#: What the classifier sees besides the votes, one letter each: length, share of digits, characters before and after.
FEATURES = {"length": "sml", "digits": "nfa", "before": "spw", "after": "spw"}


def _near(c: str) -> str:
    return "s" if not c or c.isspace() else "w" if c.isalnum() else "p"


def features(t: str, start: int, end: int) -> str:
    """One letter per feature: length up to 14, 24 or more; no digits, up to 60 %, more; space or edge, other sign, word character."""
    span = t[start:end]
    signs = [c for c in span if c.isalnum()]
    share = sum(c.isdigit() for c in signs) / max(1, len(signs))
    length = "s" if len(span) <= 14 else "m" if len(span) <= 24 else "l"
    return length + ("n" if not share else "f" if share <= 0.6 else "a") + _near(t[max(0, start - 1) : start]) + _near(t[end : end + 1])


def votes(kind: str, t: str, start: int, end: int) -> str:
    """One character per labeler: + for, - against, 0 no opinion. Looks at 40 characters before the span."""
    span, before = t[start:end], t[max(0, start - 40) : start].lower()
    symbols = [c for c in span.lower() if c.isalnum()]
    if kind == "ssn":
        strict = span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00" and span[7:] != "0000"
    elif kind == "national_phone":
        strict = re.sub("[^0-9]", "", span)[-10] not in "01"
    elif kind == "grouped_card":
        strict = luhn(re.sub("[^0-9]", "", span))
    elif kind == "iban":
        strict = int("".join(str(int(c, 36)) for c in span[4:] + span[:4])) % 97 == 1
    elif kind == "secret":
        strict = len(span) in (32, 40, 64)
    else:
        strict = True
    known = not set(GAZETTEER[kind]).isdisjoint(_WORD.findall(before))
    return "".join(
        (
            "+" if strict else "-",
            "+" if known else "0",
            "+" if _CONTEXT.search(before) else "0",
            "+" if len(set(symbols)) >= 5 else "-",
            "0" if (not before or before[-1] in " \t\n\"'(:=") and t[end : end + 1] in ("", " ", "\n", '"', "'", ")", ".", ",", ";") else "-",
        )
    )


def candidates(t: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int, str]]:
    """Spans of the further shapes that touch no base span, leftmost first, none overlapping another, each with a letter per
    labeler and feature."""
    if not _DIGIT.search(t) and "(at" not in t and "[at" not in t:
        return []
    taken = sorted(s for spans in base.values() for s in spans)
    found = sorted((m.start(), -m.end(), k) for k, p in _SHAPE.items() if k != "spelled_email" or "at)" in t or "at]" in t for m in p.finditer(t))
    out, free = [], 0
    starts = np.array([s for s, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    for start, end, kind in ((s, -e, k) for s, e, k in found):
        i = int(np.searchsorted(starts, end))
        if start >= free and not (i and reach[i - 1] > start):
            out.append((kind, start, end, votes(kind, t, start, end) + features(t, start, end)))
            free = end
    return out


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, counts of base spans, base spans and voted candidates as text: one row per row; null text is empty."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        counts, base, more = [], [], []
        for t in map(pa.StringScalar.as_py, b.column(1)):
            spans = base_spans(t or "")
            counts.append([len(spans[k]) for k in KINDS])
            base.append(",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k]))
            more.append(",".join(f"{k}:{s}:{e}:{v}" for k, s, e, v in candidates(t or "", spans)))
        cols = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
        return pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array(base, pa.string()), pa.array(more, pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "candidates"])

    return map_batches(docs.select("doc_id", F.col(text).alias("t")), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, candidates string")


def reliabilities(patterns: dict[tuple[str, str], int], rounds: int = 30) -> tuple[dict[tuple[str, str], float], np.ndarray]:
    """EM for a two-class model of independent labelers that may abstain: the posterior of each (kind, votes and features),
    which rests on the votes alone, and for a false and a true span each labeler's chance of voting against and for it, if it
    votes. An abstention says nothing (its entry is 1): key words are rare for some kinds, and common for others."""
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    v = np.array([["-0+".index(c) for c in k[1][: len(LABELERS)]] for k in keys], int).reshape(len(keys), len(LABELERS))
    kind = np.array([ADDED.index(k[0]) for k in keys], int)
    post = 1 / (1 + np.exp(-1.5 * (v - 1).sum(axis=1)))  # starts from the sum of the votes
    table = np.zeros((2, len(LABELERS), 3))
    for _ in range(rounds):
        prior = np.array([(1 + (n * post)[kind == k].sum()) / (2 + n[kind == k].sum()) for k in range(len(ADDED))])
        for c, w in ((1, n * post), (0, n * (1 - post))):
            for j in range(len(LABELERS)):
                hits = np.bincount(v[:, j], weights=w, minlength=3) + (np.array([0.2, 0, 1.8]) if c else np.array([1.8, 0, 0.2]))
                table[c, j] = hits / (hits[0] + hits[2])
                table[c, j, 1] = 1
        like = [np.log(table[c, np.arange(len(LABELERS)), v]).sum(axis=1) for c in (0, 1)]
        odds = np.log(prior[kind] / (1 - prior[kind])) + like[1] - like[0]
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(keys, post.tolist())), table


def classifier(patterns: dict[tuple[str, str], int], post: dict[tuple[str, str], float], rounds: int = 400) -> dict[tuple[str, str], float]:
    """Logistic regression of the posteriors on kind, votes and features, weighted with the counts; its chance for each pattern."""
    keys, m = sorted(patterns), len(LABELERS)

    def row(kind: str, code: str) -> list[float]:
        shape = [c == x for c, values in zip(code[m:], FEATURES.values()) for x in values]
        return [1.0, *(kind == a for a in ADDED), *(c == x for c in code[:m] for x in "+-"), *shape]

    x = np.array([row(*k) for k in keys], float).reshape(len(keys), -1 if keys else 1)
    y, n = np.array([post[k] for k in keys]), np.array([patterns[k] for k in keys], float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds if len(keys) else 0):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 1.0 * ((x * (n * (p - y))[:, None]).sum(axis=0) / n.sum() + 1e-4 * w)
    return dict(zip(keys, (1 / (1 + np.exp(-x @ w))).tolist() if len(keys) else []))


def decide(scanned: DataFrame, threshold: float = 0.5) -> dict[str, float]:
    """Chance of each accepted (kind:votes and features) pattern; 6 kinds by 3 values of 5 labelers and 4 features bound the
    table that is collected, whatever the number of documents (118,098 patterns; some dozens occur)."""
    each = scanned.where("candidates <> ''").select(F.explode(F.split("candidates", ",")).alias("c"))
    code = F.concat_ws(":", F.element_at(F.split("c", ":"), 1), F.element_at(F.split("c", ":"), 4))
    patterns = {tuple(r["code"].split(":")): r["count"] for r in each.groupBy(code.alias("code")).count().collect()}
    post, _ = reliabilities(patterns)
    return {":".join(k): p for k, p in classifier(patterns, post).items() if p > threshold}


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, counts, base_sha256, spans (base, then added kinds, each by start): one row per row of docs.

    Null texts are empty and have no spans; texts of any length are searched whole, in linear time; rows that repeat an id or a
    text are rows of their own, each with its spans; a span is accepted above the threshold; further columns are not
    looked at; an empty table gives an empty result."""
    scanned = materialize(scan(docs, text), "pii")
    accepted = decide(scanned)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        sha, out = [], []
        for base, more in zip(b.column(5).to_pylist(), b.column(6).to_pylist()):
            sha.append(hashlib.sha256(base.encode()).hexdigest())
            added = [c.split(":") for c in more.split(",") if c]
            kept = sorted((ADDED.index(k), int(s), int(e), k) for k, s, e, v in added if f"{k}:{v}" in accepted)
            out.append(",".join([*filter(None, [base]), *(f"{k}:{s}:{e}" for _, s, e, k in kept)]))
        return pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sha, pa.string()), pa.array(out, pa.string())], names=[*b.schema.names[:5], "base_sha256", "spans"])

    return map_batches(scanned, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def accepted_spans(t: str | None, accepted: dict[str, float]) -> str:
    """All spans of one text in the form of `spans`, for vote patterns that were accepted."""
    base = base_spans(t or "")
    more = [f"{k}:{s}:{e}" for k, s, e, v in candidates(t or "", base) if f"{k}:{v}" in accepted]
    return ",".join([*(f"{k}:{s}:{e}" for k in KINDS for s, e in base[k]), *more])


def mask(t: str | None, spans_text: str) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    if not t or not spans_text:
        return t
    out, free = [], 0
    for start, end, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans_text.split(","))):
        if start >= free:
            out += [t[free:start], f"[{kind.upper()}]"]
        free = max(free, end)
    return "".join([*out, t[free:]])
