"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The patterns find e-mail addresses, IPv4 addresses, card and phone numbers. The field labels the
words around every digit, at sign and word for a secret with one of six kinds or none, from
word-shape features of the word and its neighbours; it is trained by gradient ascent on a small
labelled table and decoded by Viterbi over padded numpy batches. A span of the field counts if each
of its words has at least ACCEPT probability of its kind, and is added where it overlaps no span found
by a pattern: passwords, keys and tokens, account and social security numbers, and forms of the four
kinds that the patterns don't know (phone numbers without +, spelled-out at signs, other groupings).
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the field knows.
MORE_KINDS = ("secret", "account")
TAGS = ("none", *KINDS, *MORE_KINDS)
CONTEXT, ACCEPT = 3, 0.8
EXAMPLES, EPOCHS, RATE, L2 = 2400, 8, 0.3, 1e-4

# Each pattern can only start where its first run of characters starts, or where the last match
# ended; so long runs are looked at once. Possessive runs give the same matches without backtracking.
_EMAIL = (re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"))
_IP = (re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), re.compile(r"[0-9]++(?:\.[0-9]++){3}"))
_CARD = (re.compile(r"[0-9](?:[\x20-]?[0-9])+"),) * 2
_PHONE = (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),) * 2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 13 <= len(d) <= 19 and luhn(d)


def _small(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) <= 3 and int(p or 0) <= 255


_CHECKS = {
    "email": lambda s: True,
    "ip": lambda s: all(map(_small, s.split("."))),
    "card": _card_ok,
    "phone": lambda s: 9 <= len(_digits(s)) <= 15,
}
_PATTERNS = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; leftmost, not overlapping within a kind; matches that
    fail their check are dropped without another try."""
    out = []
    for kind in KINDS:
        if _NEEDS[kind] not in text:
            continue
        search, follow = _PATTERNS[kind]
        pos = 0
        while True:
            m = (follow.match(text, pos) if pos else None) or search.search(text, pos)
            if m is None:
                break
            pos = m.end()
            if _CHECKS[kind](m[0]):
                out.append((kind, m.start(), pos))
    return out


def shape(word: str) -> str:
    """Letters as a or A, digits as 9, runs of one cut to one; other characters stay."""
    s = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a", word))
    return s if len(s) <= 24 else s[:12] + "~" + s[-12:]


_EDGES = ".,;:!?\"'<>#%$&*|=()[]{}"


def _runs(words: list[str]) -> list[str]:
    """What the run of digit words around each word makes up: its number of digits and whether they pass Luhn."""
    out, i = [""] * len(words), 0
    digits = [_digits(w) if not any(c.isalpha() for c in w) else "" for w in words]
    while i < len(words):
        j = i
        while j < len(words) and digits[j]:
            j += 1
        if j > i:
            d = "".join(digits[i:j])
            kind = f"{len(d)}{luhn(d)}" if 13 <= len(d) <= 19 else str(min(len(d), 20))
            out[i:j] = [kind] * (j - i)
        i = max(j, i + 1)
    return out


def _make_up(word: str) -> str:
    """Kinds of characters in a word, and about how many it has."""
    core = word.strip(_EDGES)
    n = len(core)
    kinds = "".join(k for k, p in (("d", r"[0-9]"), ("l", r"[a-z]"), ("u", r"[A-Z]"), ("x", r"[^\W\d_a-zA-Z]"), ("_", r"[_-]"), ("/", r"[/+=]"), ("@", "@"), (".", r"\.")) if re.search(p, core))
    if kinds and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", core):
        kinds = "hex"
    return f"{kinds}{0 if n < 6 else 6 if n < 10 else 10 if n < 16 else 16 if n < 24 else 24 if n < 48 else 48}"


def features(words: list[str]) -> list[list[str]]:
    """Feature names of every word of a sequence: its own shape, counts and the shapes beside it."""
    shapes, low = [shape(w) for w in words], [w.lower().strip(_EDGES) for w in words]
    runs = _runs(words)
    out = []
    for i, w in enumerate(words):
        n = sum("0" <= c <= "9" for c in w)
        size = 0 if n == 0 else 1 if n < 3 else 3 if n < 5 else 5 if n < 7 else 7 if n < 9 else 9 if n < 13 else 13 if n < 20 else 20
        before, after = (shapes[i - 1] if i else "^"), (shapes[i + 1] if i + 1 < len(words) else "$")
        kinds = _make_up(w)
        f = ["b", "s=" + shapes[i], f"n={size}", "s<" + before, "s>" + after, f"n={size}&<{before}", f"n={size}&>{after}", "k=" + kinds, "r=" + runs[i]]
        if n == 0:
            f.append("w=" + low[i])
        ip = re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", low[i])
        if ip:
            f.append(f"ip={_CHECKS['ip'](low[i])}")
        key = re.match(r"([A-Za-z_.-]{2,24})[=:]", w)
        if key:
            f += ["key=" + key[1].lower(), f"key=&{kinds}"]
        if i:
            f.append("w<" + low[i - 1] if not any(map(str.isdigit, low[i - 1])) else "d<")
        # the name before a value: the last word but signs and "is"
        name = next((x for x in low[max(0, i - 3) : i][::-1] if x not in ("", "is")), "^")
        if n or "@" in w:
            name = name if not any(map(str.isdigit, name)) else "9"
            f += ["nm=" + name, f"nm={name}&{kinds}", f"nm={name}&n={size}"]
        if "@" in w:
            f.append(f"@={re.search(r'[^@]@[^@]+[.][^@]', low[i]) is not None}")
        if i + 1 < len(words):
            f.append("w>" + low[i + 1] if not any(map(str.isdigit, low[i + 1])) else "d>")
        out.append(f)
    return out


def _examples(n: int = EXAMPLES, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Labelled word sequences drawn from templates: words, and a tag for each of them. In a template
    (kind, text) the words of text between braces are personal data, the others are not."""
    rng = random.Random(seed)
    pick, letters = rng.choice, "abcdefghijklmnopqrstuvwxyzäéñö"
    word = lambda: "".join(pick(letters) for _ in range(rng.randint(2, 9)))
    num = lambda k: "".join(pick("0123456789") for _ in range(k))
    of = lambda chars, k: "".join(pick(chars) for _ in range(k))
    hexed = lambda k: (lambda x: x.upper() if rng.random() < 0.2 else x)(of("0123456789abcdef", k))
    mixed = lambda k: of("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k)
    upper = lambda k: of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k)

    def card(good=True) -> str:
        body = num(15)
        body += next(c for c in "0123456789" if luhn(body + c) == good)
        cut = pick([None, " ", "-", ".", "/"])
        return body if cut is None else cut.join(body[i : i + 4] for i in range(0, 16, 4))

    def named(names, value) -> str:
        """A name for a value: {value} stands for itself."""
        name, quote = pick(names), pick(['"', "'", "", ""])
        name = pick([name, name.upper(), name.capitalize()])
        joined = pick(["{n} = {q}{v}{q}", "{n} : {q}{v}{q}", "{n}: {q}{v}{q}", "{n} is {q}{v}{q}", "{n} {q}{v}{q}", "{n}={q}{v}{q}", "{n}:{q}{v}{q}"])
        return joined.format(n=name, q=quote, v=value) if joined[3] in "=:" and joined[4] != " " else joined.format(n=name, q="", v="{" + quote + value + quote + "}")

    secret_names = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "key", "access_token", "auth", "client_secret", "credential", "bearer")
    secrets = (lambda: hexed(pick([32, 40, 64])), lambda: mixed(pick([16, 20, 24, 32, 40])), lambda: mixed(rng.randint(6, 12)) + pick("!#$%") + num(2), lambda: word() + num(3))
    keys = (lambda: "{AKIA" + upper(16) + "}", lambda: "{ghp_" + mixed(36) + "}", lambda: "{sk-" + mixed(40) + "}", lambda: "{eyJ" + mixed(30) + "." + mixed(20) + "}")
    make = {
        "email": (lambda: "{" + f"{word()}.{num(2)}@{word()}{pick(['', num(1)])}.{word()}.com" + "}", lambda: "{" + f"{word()}{pick('._-+')}{word()}{pick(['', num(3)])}@{word()}{pick(['', num(2)])}.{pick(['com', 'net', 'de', 'es'])}" + "}", lambda: "{" + f"{word()}@{word()}.org" + "}", lambda: "{" + f"{word()} (at) {word()}.com" + "}", lambda: "{" + f"{word()} [at] {word()}.net" + "}", lambda: "{" + f"{word()}(at){word()}.org" + "}"),
        "ip": (lambda: "{" + ".".join(str(rng.randint(0, 255)) for _ in range(4)) + "}",),
        "card": (lambda: "{" + card() + "}",),
        "phone": (lambda: "{" + f"+1 ({num(3)}) {num(3)}-{num(4)}" + "}", lambda: "{" + f"({num(3)}) {num(3)}-{num(4)}" + "}", lambda: "{" + f"{num(3)}-{num(3)}-{num(4)}" + "}", lambda: "{" + f"{num(3)}.{num(3)}.{num(4)}" + "}", lambda: "{" + f"+{num(2)} {num(3)} {num(6)}" + "}", lambda: "{" + f"00{num(2)} {num(3)} {num(7)}" + "}", lambda: pick(["phone", "tel", "call", "mobile"]) + " {" + f"{num(3)} {num(3)} {num(4)}" + "}"),
        "secret": (*[lambda: named(secret_names, pick(secrets)())] * 4, lambda: pick(keys)()),
        "account": (lambda: "{" + pick("ABDEFGILNPST") + pick("ABDEFGILNPST") + num(2) + num(18) + "}", lambda: "{" + pick("ABDEFGILNPST") + pick("ABDEFGILNPST") + num(2) + " " + " ".join(num(4) for _ in range(4)) + "}", lambda: pick(["ssn", "ssn:", "social security number", "SSN"]) + " {" + f"{num(3)}-{num(2)}-{num(4)}" + "}"),
    }
    plain = (
        lambda: str(rng.randint(0, 3000)), lambda: num(rng.randint(5, 12)), lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.20{num(2)}", lambda: f"20{num(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(0, 23)}:{num(2)}", lambda: f"${num(2)}.{num(2)}", lambda: f"v{num(1)}.{num(1)}.{num(2)}", lambda: f"{num(1)},{num(3)}", lambda: f"{num(2)}%", lambda: f"{word()}{num(2)}",
        lambda: f"({num(4)})", lambda: f"@{word()}", lambda: f"{num(4)}-{num(4)}", lambda: f"{num(1)}.{num(1)}", lambda: f"[{num(2)}]", lambda: f"{num(3)} {num(3)}", lambda: f"#{num(5)}", lambda: f"{num(2)}.{num(2)}.{num(2)}.{rng.randint(256, 999)}",
        lambda: card(good=False), lambda: pick(["commit", "sha", "md5", "checksum", "revision", "build", "id"]) + pick([" ", " = ", ": "]) + hexed(pick([7, 32, 40])), lambda: pick(secret_names) + " " + word(), lambda: pick(["order", "item", "width", "page", "count", "version", "year"]) + pick([" = ", "=", ": "]) + num(rng.randint(1, 6)),
        lambda: f"the {pick(secret_names)} of {word()}", lambda: f"https://{word()}.com/{word()}/{num(5)}", lambda: " ".join(num(rng.randint(1, 3)) for _ in range(4)), lambda: " | ".join(num(rng.randint(1, 4)) for _ in range(3)), lambda: upper(5) + num(3), lambda: "==== ====",
    )
    signs = ("", "", "", "", ".", ",", "!!", "***", "###", "%%%", ";", " |")
    out = []
    for _ in range(n):
        words, tags, hold = [], [], pick(signs)
        ends = lambda: hold if rng.random() < 0.5 else pick(signs)
        for _ in range(rng.randint(1, 3)):
            before = [word() + ends() for _ in range(rng.randint(0, CONTEXT))]
            kind = pick([*TAGS[1:], "secret", *["none"] * 6])
            text = " ".join(before) + " " + (pick(plain) if kind == "none" else pick(make[kind]))() + ends()
            if rng.random() < 0.1:
                text = text.upper() if "@" not in text else text
            inside = False
            for part in text.split():
                at = "{" in part
                held = at or inside or (kind == "secret" and "{" not in text and re.search(r"[=:].", part) is not None)
                inside = (inside or at) and "}" not in part
                words.append(part.replace("{", "").replace("}", ""))
                tags.append(kind if held else "none")
        out.append((words, tags))
    return out


def labelled_table(spark: SparkSession) -> DataFrame:
    """The default training table: words array<string>, tags array<string>."""
    return spark.createDataFrame(_examples(), "words array<string>, tags array<string>")


@dataclass
class ChainField:
    index: dict[str, int]
    weights: np.ndarray  # features x tags
    steps: np.ndarray  # tag x tag

    def chances(self, words: list[str]) -> np.ndarray:
        """The probability of every tag at every word of a sequence."""
        return _marginals(self.unary(words), self.steps)[0]

    def unary(self, words: list[str]) -> np.ndarray:
        find = self.index.get
        return np.array([self.weights[[k for x in f if (k := find(x)) is not None]].sum(axis=0) for f in features(words)])

    def decode(self, sequences: list[list[str]]) -> list[list[int]]:
        """The best tags of each sequence: one Viterbi pass over all, padded to a common length."""
        out: list[list[int]] = [[] for _ in sequences]
        order = sorted((i for i, s in enumerate(sequences) if s), key=lambda i: len(sequences[i]))
        for start in range(0, len(order), 256):
            group = order[start : start + 256]
            n = np.array([len(sequences[i]) for i in group])
            u = np.zeros((len(group), n.max(), len(TAGS)))
            for g, i in enumerate(group):
                u[g, : n[g]] = self.unary(sequences[i])
            best, back = u[:, 0], []
            for t in range(1, n.max()):
                total = best[:, :, None] + self.steps[None]
                back.append(total.argmax(axis=1))
                best = np.where((t < n)[:, None], total.max(axis=1) + u[:, t], best)
            for g, i in enumerate(group):
                tag = int(best[g].argmax())
                path = [tag]
                for t in range(int(n[g]) - 2, -1, -1):
                    tag = int(back[t][g, tag])
                    path.append(tag)
                out[i] = path[::-1]
        return out


def _marginals(u: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Probabilities of the tags by forward and backward sums; with both sums and the log of the total."""
    fwd, bwd = np.zeros_like(u), np.zeros_like(u)
    fwd[0] = u[0]
    for t in range(1, len(u)):
        fwd[t] = u[t] + np.logaddexp.reduce(fwd[t - 1][:, None] + steps, axis=0)
    for t in range(len(u) - 2, -1, -1):
        bwd[t] = np.logaddexp.reduce(steps + (u[t + 1] + bwd[t + 1])[None], axis=1)
    z = float(np.logaddexp.reduce(fwd[-1]))
    return np.exp(fwd + bwd - z), fwd, bwd, z


def train(rows: list[tuple[list[str], list[str]]], epochs: int = EPOCHS) -> ChainField:
    """Gradient ascent on the conditional log-likelihood, one labelled sequence at a time."""
    index: dict[str, int] = {}
    data = []
    for words, tags in rows:
        if words:
            f = [[index.setdefault(x, len(index)) for x in fs] for fs in features(list(words))]
            data.append((f, [TAGS.index(t) for t in tags]))
    w, steps = np.zeros((len(index), len(TAGS))), np.zeros((len(TAGS), len(TAGS)))
    rng = np.random.default_rng(1)
    for epoch in range(epochs):
        rate = RATE / (1 + epoch)
        for k in rng.permutation(len(data)):
            f, y = data[k]
            u = np.array([w[x].sum(axis=0) for x in f])
            p, fwd, bwd, z = _marginals(u, steps)
            for t in range(len(f)):
                g = -p[t]
                g[y[t]] += 1
                w[f[t]] += rate * g
                if t:
                    pair = np.exp(fwd[t - 1][:, None] + steps + (u[t] + bwd[t])[None] - z)
                    steps -= rate * pair
                    steps[y[t - 1], y[t]] += rate
        w *= 1 - L2
    return ChainField(index, w, steps)


_HINT = re.compile(r"[0-9@]|[(\[]at[)\]]|(?i:passw|passwd|pwd|secret|token|credential|bearer|api_?key)")
_WORD = re.compile(r"\S+")


def _windows(text: str) -> list[list[tuple[int, int]]]:
    """Word spans around every word with a digit or an at sign, CONTEXT words to either side; windows
    that touch are one."""
    if _HINT.search(text) is None:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    hot = [i for i, (a, b) in enumerate(spans) if _HINT.search(text, a, b)]
    out: list[list[int]] = []
    for i in hot:
        lo, hi = max(0, i - CONTEXT), min(len(spans), i + CONTEXT + 1)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [spans[a:b] for a, b in out]


_KEY = re.compile(r"[A-Za-z_.-]{2,24}[=:]+[\"']*")


def _trimmed(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    """The span without signs at its ends (but brackets of a phone number) and without the name of a secret."""
    key = _KEY.match(text, a, b) if kind == "secret" else None
    a = key.end() if key else a
    while a < b and text[a] in _EDGES and not (kind == "phone" and text[a] == "("):
        a += 1
    while a < b and text[b - 1] in _EDGES:
        b -= 1
    return a, b


def field_spans(texts: list[str], field: ChainField) -> list[list[tuple[str, int, int]]]:
    """The field's spans in each text."""
    windows = [(k, w) for k, t in enumerate(texts) for w in _windows(t)]
    sequences = [[texts[k][a:b] for a, b in w] for k, w in windows]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (k, w), words, path in zip(windows, sequences, field.decode(sequences), strict=True):
        if not any(path):
            continue
        chances, i = field.chances(words), 0
        while i < len(w):
            j = i
            while j < len(w) and path[j] == path[i] and (j == i or not _card_ok(words[j - 1]) or TAGS[path[i]] != "card"):
                j += 1
            if path[i] and chances[i:j, path[i]].min() >= ACCEPT:
                a, b = _trimmed(TAGS[path[i]], texts[k], w[i][0], w[j - 1][1])
                if a < b:
                    out[k].append((TAGS[path[i]], a, b))
            i = j
    return out


def added_spans(texts: list[str], field: ChainField, base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Spans of the field in each text that overlap none of the text's base spans."""
    found = field_spans(texts, field)
    return [[s for s in new if all(s[2] <= x or y <= s[1] for _, x, y in old)] for new, old in zip(found, base, strict=True)]


def _find(field):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t.as_py() or "" for t in part.column(1)]
                base = [base_spans(t) for t in texts]
                more = added_spans(texts, field, base)
                form = [[{"kind": k, "start": a, "end": b, "added": new} for new, spans in ((False, x), (True, y)) for k, a, b in spans] for x, y in zip(base, more, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(form, _SPANS)], ["doc_id", "spans"])

    return run


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))


def find_personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, spans (kind, start, end in code points, added by the field or not) of every row.

    ``labelled`` (words, tags) is a small table and is read by the driver. Null and empty texts have
    no span; null ids stay null; repeated rows are each searched; an empty table gives an empty
    result; other columns are not read.
    """
    table = labelled if labelled is not None else labelled_table(docs.sparkSession)
    field = train([(r.words, r.tags) for r in table.select("words", "tags").collect()])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_find(field), "doc_id long, spans array<struct<kind: string, start: long, end: long, added: boolean>>")


def _text_of(spans) -> F.Column:
    """Spans as kind:start:end, by kind in the order of KINDS and MORE_KINDS, then start."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, *MORE_KINDS)])
    keyed = F.transform(spans, lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("r"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["k"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def _count_of(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of the patterns' spans, their hash, and all spans as text; ordered by kind, then start."""
    base = F.filter("spans", lambda s: ~s["added"])
    return found.select(
        "doc_id",
        *[_count_of(base, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_text_of(base).cast("binary"), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["added"])).cast("long").alias("n_added"),
    )
