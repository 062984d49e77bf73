"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors: at-signs, plus signs, digits, schemes and identifier
cues. From each anchor a deterministic parser for its kind expands to the left and right, one linear
step at a time, and validates what it found. The four base kinds (email, ip, card, phone) are the
leftmost, non-overlapping matches of

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)        parts at most 255
    card   [0-9]([\\x20-]?[0-9])+                        16 to 19 digits that pass Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9]                   8 to 15 digits

without a search over the whole text for each; a match that fails its check is dropped and not tried
again. Three more kinds come from the other anchors: ``url`` (an address that holds a user name, or a
mailto: or tel: link), ``account`` (an identifier after a cue such as "iban" or "account no") and ``secret`` (what is
assigned to a cue such as "password" or "token", and keys of a known form that begin with their cue).

Texts stay in their partition; there is no shuffle. Defined results: a null text is an empty text and
has no spans; repeated rows are rows of their own; further columns are ignored by the report and kept
by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tapewright.llm.util import named

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "account", "secret")
KINDS = BASE + ADDED

SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "passport", "ssn")

SECRET_CUES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "private_key")
# fixed values: the published forms of keys that begin with a mark of their own
KEY_FORMS = {
    "akia": re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    "ghp_": re.compile(r"ghp_[0-9A-Za-z]{36}"),
    "sk-": re.compile(r"sk-[0-9A-Za-z_-]{20,}"),
    "sk_live_": re.compile(r"sk_live_[0-9A-Za-z]{16,}"),
    "xoxb-": re.compile(r"xoxb-[0-9A-Za-z-]{20,}"),
    "aiza": re.compile(r"AIza[0-9A-Za-z_-]{35}"),
    "eyj": re.compile(r"eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]*"),
    "-----begin": re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_DIAL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USER_URL = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?(?:/[^\s<>\"]*)?")
_MAIL_URL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_TEL_URL = re.compile(r"\+?[0-9][0-9().-]{5,}[0-9]")
_AFTER_CUE = re.compile(
    r"(?: ?(?:no|nr|number|id))?\.? ?[:#=]? ?(?=[A-Za-z0-9]*[0-9])([A-Za-z0-9]+(?:[ -](?=[A-Za-z]*[0-9])[A-Za-z0-9]{2,}){0,12})",
    re.I,
)


_ASSIGNED = re.compile(r"[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?([^\s\"'<>,;]{6,})")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban(value: str) -> bool:
    value = value.upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for sign in ("@", "+", *"0123456789"):
        automaton.add_word(sign, ("#" if sign.isdigit() else sign, 1))
    for scheme in SCHEMES:
        automaton.add_word(scheme, (scheme, len(scheme)))
    for cue in CUES:
        automaton.add_word(cue, ("cue", len(cue)))
    for cue in SECRET_CUES:
        automaton.add_word(cue, ("assigned", len(cue)))
    for mark in KEY_FORMS:
        automaton.add_word(mark, (mark, len(mark)))
    automaton.make_automaton()
    return automaton


def find(text: str, automaton: ahocorasick.Automaton, anchored: str | None = None) -> dict[str, list[tuple[int, int]]]:
    """Spans in code points, end exclusive, by kind. ``anchored``: the text with cues in lower case."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    emails, ips, cards, phones, urls, accounts, secrets = found.values()
    mail_from = dot_to = digit_to = dial_to = url_to = account_to = secret_to = 0
    size = len(text)
    for last, (kind, width) in automaton.iter(text if anchored is None else anchored):
        at = last + 1 - width
        if kind == "#":
            if at >= digit_to:
                match = _DIGITS.match(text, at)
                digit_to = match.end()
                if digit_to - at >= 16:
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        cards.append((at, digit_to))
            if at >= dot_to:
                match = _DOTTED.match(text, at)
                dot_to = match.end()
                if dot_to - at >= 7:
                    parts = match[0].split(".")
                    start = at
                    for k in range(0, len(parts) - 3, 4):
                        four = parts[k : k + 4]
                        end = start + sum(map(len, four)) + 3
                        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                            ips.append((start, end))
                        start = end + 1
        elif kind == "@":
            start = at
            while start > mail_from and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (match := _DOMAIN.match(text, at + 1)):
                mail_from = match.end()
                emails.append((start, mail_from))
        elif kind == "+":
            if at >= dial_to and (match := _DIAL.match(text, at)):
                dial_to = match.end()
                if 8 <= sum(map(str.isdigit, match[0])) <= 15:
                    phones.append((at, dial_to))
        elif kind == "cue":
            if at < account_to or (at and text[at - 1].isalnum()):
                continue
            if last + 1 < size and (match := _AFTER_CUE.match(text, last + 1)):
                value = match[1].replace(" ", "").replace("-", "")
                if iban(value) or (6 <= len(value) <= 20 and sum(map(str.isdigit, value)) >= 6):
                    account_to = match.end(1)
                    accounts.append((match.start(1), account_to))
        elif kind == "assigned":
            if last + 1 >= secret_to and (match := _ASSIGNED.match(text, last + 1)):
                secret_to = match.end(1)
                secrets.append((match.start(1), secret_to))
        elif kind in KEY_FORMS:
            if at >= secret_to and not (at and text[at - 1].isalnum()) and (match := KEY_FORMS[kind].match(text, at)):
                secret_to = match.end()
                secrets.append((at, secret_to))
        elif at >= url_to and not (at and text[at - 1].isalnum()):
            parser = _MAIL_URL if kind == "mailto:" else _TEL_URL if kind == "tel:" else _USER_URL
            if match := parser.match(text, last + 1):
                url_to = match.end()
                urls.append((at, url_to))
    return found


def _written(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in found[kind])


def _lower(text: str) -> str:
    """A-Z to a-z, so that code points stay where they are."""
    return text.translate(_TO_LOWER)


_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def _scan(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    return find(text, automaton, text if text.islower() else text.lower() if text.isascii() else _lower(text))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = anchors()
    for batch in batches:
        counts: list[list[int]] = [[] for _ in KINDS]
        digests, spans = [], []
        for text in batch.column(1):
            found = _scan(text.as_py() or "", automaton)
            for column, kind in zip(counts, KINDS, strict=True):
                column.append(len(found[kind]))
            digests.append(hashlib.sha256(_written(found, BASE).encode()).hexdigest())
            spans.append(_written(found, KINDS))
        columns = [pa.array(c, pa.int64()) for c in counts]
        columns[len(BASE) : len(BASE)] = pa.array(digests, pa.string()), pa.array(spans, pa.string())
        names = ["doc_id", *(f"n_{kind}" for kind in BASE), "base_sha256", "spans", *(f"n_{kind}" for kind in ADDED)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)


def personal_data_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_url, n_account, n_secret, n_spans (of all kinds)."""
    (id_of,), (text_of,) = named(id_column), named(text_column)
    rows = docs.select(id_of.cast("long").alias("doc_id"), text_of.alias("text"))
    counts, more = (", ".join(f"n_{kind} long" for kind in kinds) for kinds in (BASE, ADDED))
    found = rows.mapInArrow(_report, f"doc_id long, {counts}, base_sha256 string, spans string, {more}")
    return found.withColumn("n_spans", sum((F.col(f"n_{kind}") for kind in KINDS[1:]), F.col(f"n_{KINDS[0]}")))


@F.arrow_udf(StringType())
def _masked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    automaton = anchors()
    for batch in batches:
        out = []
        for value in batch:
            text = value.as_py()
            if text:
                found = _scan(text, automaton)
                spans = sorted((a, -b, kind) for kind in KINDS for a, b in found[kind])
                parts, at = [], 0
                for a, b, kind in spans:
                    if a >= at:
                        parts += text[at:a], f"<{kind}>"
                    at = max(at, -b)
                text = "".join(parts) + text[at:]
            out.append(text)
        yield pa.array(out, pa.string())


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The input's rows and columns; every span in the text becomes its kind in angle brackets."""
    return docs.select(*[_masked(c).alias(n) if n == text_column else c for n, c in zip(docs.columns, named(*docs.columns), strict=True)])
