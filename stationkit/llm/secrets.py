"""Secret scanning: fixed formats, and values priced by guess cost.

Base spans are leftmost non-overlapping matches of three patterns: ``assign``
(a credential name, a colon or equals sign, and a value of 6 or more
characters; the span is the whole match), ``access`` (AKIA key ids of 20 or
more characters) and ``hex`` (runs of 24 or more lower-case hex digits).

The method adds ``guess`` spans: values in a wider credential context (other
names and languages, names behind a prefix as in DB_PASS or userPwd, "is",
"=>", bearer headers, user:password@host) whose guess cost reaches
``min_log10`` (10, that is ten thousand million guesses), whatever their
characters.  Behind "is" and its like a value must show that it is meant: quotes,
a digit, a sign that prose does not use inside words, capitals that come and
go, or next to no vowels; plain words there are prose.  A value that a base span's secret is only part of is added at any
cost, as the base span says that it is a secret; one within it adds nothing.
Values of under 6 characters and links are not added, and signs that end a
value are left out of it.  The cost is the cheapest segmentation of the value, found
by dynamic programming over its positions:

* a word costs its rank, times 2 for capitals and for digits or signs put for
  letters; ranks are those of the list below or, if lower, those by count in the
  corpus itself: one distributed count of all words outside credential values,
  of which the ``CORPUS_WORDS`` commonest that occur ``LEAST_COUNT`` times go to the tasks;
* a date costs a day among 200 years; a year the same without the day;
* a repeated block costs its block times the number of repeats;
* a walk along keyboard rows costs its start keys and direction times its length;
* what is left is brute force, by the size of the character's class.

Every segment after the first multiplies by 2, for the ways to arrange them.

Defined cases: null text counts as empty; a text without secrets has zero
counts, the SHA-256 of nothing, and an empty span list; texts of any length are
scanned whole; spans that start together come in the order of their kinds;
repeated rows are each scanned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_of, written

#: words of the corpus that have a rank, and how often such a word occurs at least
CORPUS_WORDS = 50_000
LEAST_COUNT = 3
#: different words that a task counts before it hands its counts on
HELD_WORDS = 300_000

KINDS = ("assign", "access", "hex", "guess")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_BYTES = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))

CONTEXT = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "kennwort", "clave",
           "contrase", "pin", "://", "login")
# a name starts a word, follows an underscore, or is a capital after a small letter
_START = r"(?:(?<![^\W_])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"
# these say what they are behind any prefix, when a sign assigns a value
_PLAIN = r"(?:pass(?:word|wort|wd|phrase|code)|pwd|kennwort|contraseña|credentials?|secret|token)"
_SIGN = r"\x20*(?::=|=>|[:=]|->)\x20*"
# a value ends at white space, a list's comma or bracket, the next field of a
# query string, or a closing tag
_CONTEXT = re.compile(
    rf"""(?:{_START}(?:pass(?:word|wort|wd|phrase|code)?|pwd|kennwort|contraseña|clave|mot\x20de\x20passe|pin|credentials?|
    (?:client|app|shared)?[_-]?secret|(?:api|access|private|signing|master|account|storage|secret|encryption)[_\x20-]?key|
    (?:auth|access|refresh|session)?[_-]?token|authorization|bearer|login)["']?
    (?:{_SIGN}|(?P<verb>\x20+(?:is|ist|est|es)\x20+)|\x20+(?=\S*[0-9]))|{_PLAIN}["']?{_SIGN})
    (?:(?:bearer|basic)\x20+)?(?P<quote>["'`]?)(?P<value>\S{{6,}}?)(?=(?P=quote)(?:[\s,;)\]}}]|$)|\s|$|&\w+=|</)""", re.I | re.X)
_URL = re.compile(r"://[^\s:/@]+:([^\s:/@]{6,})@")

# fixed values: common words of passwords and of prose, most frequent first,
# then words that follow "password is" and their like, and endings
WORDS = """password the and you that was for are with his they this have from one had word but not what all were
when your can said there use each which she how their will other about out many then them these some her would make
like him into time has look two more write see number way could people than first water been call who oil now find
long down day did get come made may part love admin welcome login master dragon monkey shadow sunshine princess
football baseball letmein qwerty abc iloveyou trustno hello freedom whatever michael jordan superman batman hunter
ranger summer winter spring autumn secret token test user guest root default example changeme public private key
value none null true false string access data system server client house world orange apple cheese computer internet
service manager office company money angel star killer charlie thomas robert daniel george andrea pepper ginger
cookie banana purple silver golden soccer hockey tigger maggie buster harley flower london paris berlin madrid
passwort kennwort contrasena clave motdepasse geheim
information required incorrect invalid correct wrong missing empty optional hidden protected encrypted stored hashed
expired changed reset updated deleted removed created generated provided given needed used unused known unknown
available unavailable enabled disabled allowed denied granted blocked locked unlocked open closed active inactive
valid accepted rejected refused forgotten forgot lost stolen leaked shared private secure insecure strong weak short
simple complex easy difficult hard important necessary essential usually always never often sometimes already still
just only also even really very quite almost about above below between within without under over after before during
through because however therefore although while since until unless whether either neither both another same different
similar following previous next last second third several many every everything something nothing anything someone
everyone nobody somewhere here where everywhere please enter type submit send receive check verify verified confirm
confirmed sent received contact support account accounts email address phone mobile device devices network internal
external local remote global online offline website webpage page pages form field fields input output button link
click select option options setting settings preference configuration configured config parameter parameters variable
variables constant function method class object string number integer boolean character characters letter letters
digit digits symbol symbols word words phrase length minimum maximum least most least case sensitive lowercase uppercase
text file files folder directory path name names username usernames userid identity profile person people member
members group groups role roles permission permissions administrator owner customer client clients employee manager
process processes request requests response error errors failure success successful failed warning message messages
notice note notes comment description document documents example examples sample demo dummy placeholder redacted
undefined null nil unset blank hello goodbye thanks thank sorry welcome question answer problem solution reason result
results cause effect change changes copy paste print write read reading writing written save saved load loaded start
started stop stopped begin finish finished complete completed continue return returned create update delete remove
insert replace provide require include contain contains containing including included become becomes became being
been have having does doing done make made making take taken taking give giving keep kept keeping hold held holding
show shown showing tell told asked asking need want wanted think thought believe know knowing understand consider
considered called named based generation generated random unique single double multiple various general special common
normal regular standard basic advanced original current recent latest early late today tomorrow yesterday monday
tuesday wednesday thursday friday saturday sunday january february march april june july august september october
november december morning evening night week month year years century minute hour moment period forever temporary
permanent automatic manually automatically currently probably possibly certainly clearly simply directly exactly
basis against clockwise country city state government national international public political social economic
education school university student teacher family mother father brother sister child children friend friends woman
women water earth fire stone river mountain forest ocean island bridge street garden window door kitchen table chair
paper book books letter music picture movie story history science nature animal animals north south east west
northeast northwest southeast southwest black white green blue yellow brown orange great small large little young
beautiful happy strange perfect better best worse worst first early enough whole entire half part parts side front back
authentication authorization authorized unauthorized credential credentials session sessions bearer basic digest
oauth access refresh expire expires expiration lifetime signature signed signing certificate encryption decryption
database storage cloud service services application applications software hardware program version release product
production development testing staging environment project projects library package module component interface
falsch richtig korrekt erforderlich notwendig abgelaufen vergessen verloren sicher unsicher bekannt unbekannt leer
nicht immer schon noch auch sehr wieder eine einen einem einer dein mein sein ihr unser benutzer benutzername konto
wichtig gesperrt geschützt verschlüsselt gespeichert ungültig gültig gleich
incorrecte incorrect obligatoire nécessaire oublié perdu expiré valide invalide toujours jamais encore aussi votre
notre leur utilisateur compte protégé modifié requis important secrète
incorrecta incorrecto obligatoria necesaria necesario olvidada perdida caducada válida inválida siempre nunca también
usuario cuenta protegida secreta segura insegura importante requerida nueva nuevo
ing tion ation ment ness able ible ally ence ance ities ity less ful ious ous ive ized ised izes ize ers est ung
keit heit lich isch schaft""".split()
WORDS = list(dict.fromkeys(WORDS))
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
_NEXT = {(a, b) for row in KEY_ROWS for x, y in zip(row, row[1:]) for a, b in ((x, y), (y, x))}
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|"
                   r"(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d")
_YEAR = re.compile(r"(?:19|20)\d\d")
_DATE_COST, _YEAR_COST, _SEGMENT = math.log10(200 * 366), math.log10(200), math.log10(2)


def _class_cost(c: str) -> float:
    """log10 of the characters like ``c``."""
    if c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


class Prices:
    """Ranks of words: the list's and, where lower, those of ``corpus`` (words
    by falling count)."""

    def __init__(self, corpus: list[str] = ()):
        self.ranks = dict(_RANK)
        for i, w in enumerate(corpus):
            self.ranks[w] = min(math.log10(i + 2), self.ranks.get(w, math.inf))
        self.longest = max(map(len, self.ranks))
        self.known: dict[str, float] = {}

    def cost(self, value: str) -> float:
        if value not in self.known:
            if len(self.known) >= 4096:
                self.known.clear()
            self.known[value] = _cheapest(value, self.ranks, self.longest)
        return self.known[value]


_LIST = Prices()


def guess_cost(value: str, prices: Prices = _LIST) -> float:
    """log10 of the guesses of the cheapest segmentation of ``value``."""
    return prices.cost(value)


def _cheapest(value: str, ranks: dict[str, float], longest: int) -> float:
    n = len(value)
    lower = value.lower()
    if len(lower) != n:
        lower = value
    plain = "".join(LEET.get(c, c) for c in lower)
    ends: list[list] = [[] for _ in range(n)]  # segments by start: (end, cost)
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for form in {lower[i:j], plain[i:j]}:
                rank = ranks.get(form)
                if rank is not None:
                    ends[i].append((j, rank + _SEGMENT * ((value[i:j] != lower[i:j]) + (form != lower[i:j]))))
    for pattern, cost in ((_DATE, _DATE_COST), (_YEAR, _YEAR_COST)):
        for i in range(n):
            m = pattern.match(value, i) if value[i].isdigit() else None
            if m:
                ends[i].append((m.end(), cost))
    i = 0
    while i < n - 1:  # walks of three or more neighbouring keys
        j = i
        while j + 1 < n and (lower[j], lower[j + 1]) in _NEXT:
            j += 1
        if j - i >= 2:
            ends[i].append((j + 1, math.log10(94 * 2) + math.log10(j + 1 - i)))
        i = max(j, i + 1)
    for size in range(1, 9):  # a block of up to eight characters, repeated
        i = 0
        while i + 2 * size <= n:
            k = 1
            while value[i + k * size:i + (k + 1) * size] == value[i:i + size]:
                k += 1
            if k >= 3 or (k == 2 and size >= 3):
                ends[i].append((i + k * size, sum(map(_class_cost, value[i:i + size])) + math.log10(k)))
                i += k * size
            else:
                i += 1
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # best with a brute-force segment that ends here
    for i in range(n):
        here = best[i] + (_SEGMENT if i else 0.0)
        brute[i + 1] = min(brute[i], here) + _class_cost(value[i])
        best[i + 1] = min(best[i + 1], brute[i + 1])
        for j, cost in ends[i]:
            best[j] = min(best[j], here + cost)
    return best[n]


def base_spans(text: str) -> list[tuple]:
    """``(kind, start, end, secret's start, secret's end)`` of the three patterns."""
    out = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                out.append(("assign", m.start(), m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        out += [("access", *m.span(), *m.span()) for m in _ACCESS.finditer(text)]
    if b"x" * 24 in text.encode("utf-8", "surrogatepass").translate(_HEX_BYTES):
        out += [("hex", *m.span(), *m.span()) for m in _HEX.finditer(text)]
    return out


_MEANT = re.compile(r"""[0-9!@#$%^&*+=?_~|\\/<>]|[a-z][A-Z].*[a-z][A-Z]""")


def _meant(value: str) -> bool:
    """Whether a value behind "is" shows that it is one: by a digit, sign or
    capitals, or by next to no vowels."""
    if _MEANT.search(value):
        return True
    letters = [c for c in unicodedata.normalize("NFD", value.lower()) if c.isalpha()]
    return len(letters) >= 8 and sum(c in "aeiouyøæœı" for c in letters) < 0.13 * len(letters)


def context_values(text: str) -> list[tuple[int, int, bool]]:
    """Start and end of the values in a credential context, and whether prose
    may stand there (behind "is", nothing showing that a value is meant)."""
    lower = text.lower()
    if not any(c in lower for c in CONTEXT):
        return []
    out = [(m.start("value"), m.end("value"), bool(m["verb"]) and not m["quote"]) for m in _CONTEXT.finditer(text)]
    out += [(*m.span(1), False) for m in _URL.finditer(text)]
    trimmed = []
    for a, b, prose in out:
        while b > a and text[b - 1] in ".,;:!?)]}\"'`*#$%&":
            b -= 1
        trimmed.append((a, b, prose and not _meant(text[a:b])))
    return trimmed


def guessed_spans(text: str, base: list[tuple], min_log10: float, prices: Prices = _LIST) -> list[tuple]:
    """Values in a credential context that are hard to guess, or that go on
    where a secret of ``base`` ends."""
    out = {}
    for a, b, prose in context_values(text):
        value = text[a:b]
        if prose or len(value) < 6 or "://" in value or any(s <= a and b <= e for *_, s, e in base):
            continue  # prose, too short, a link, or masked as a whole already
        if any(a < e and s < b for *_, s, e in base) or prices.cost(value) >= min_log10:
            out[a, b] = ("guess", a, b, a, b)
    return list(out.values())


def scan(text: str, min_log10: float = 10.0, prices: Prices = _LIST) -> list[tuple]:
    """All spans, by start, then kind."""
    base = base_spans(text)
    return sorted(base + guessed_spans(text, base, min_log10, prices), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_WORD = re.compile(r"[^\W\d_]+")


def _counted(text: str) -> list[str]:
    """Lower-case words of 3 to 24 letters outside secrets and credential values."""
    hidden = [s[3:5] for s in base_spans(text)] + [v[:2] for v in context_values(text) if not v[2]]
    if hidden:
        out, at = [], 0
        for a, b in sorted(hidden):
            out.append(text[at:max(at, a)])
            at = max(at, b)
        text = " ".join([*out, text[at:]])
    return [w for w in _WORD.findall(text.lower()) if 3 <= len(w) <= 24]


def corpus_words(docs: DataFrame, text_col: str = "text", most: int = CORPUS_WORDS, least: int = LEAST_COUNT) -> list[str]:
    """The ``most`` commonest words of all texts, most frequent first."""
    bounded_batches(docs.sparkSession)

    def each(batches):
        counts: Counter = Counter()

        def part():
            words = list(counts)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())],
                                              ["word", "n"])

        for b in batches:
            for t in text_of(b, 0):
                counts.update(_counted(t))
            if len(counts) >= HELD_WORDS:
                yield part()
                counts.clear()
        yield part()

    counts = written(docs.select(F.col(text_col).alias("text")).mapInArrow(each, "word string, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "corpus-words")
    # counts of counts on a log scale (some hundred rows) give a bound that leaves few
    # words too many, so that tasks do not all send their commonest to the driver
    level = F.floor(F.log2("n") * 16)
    bound, found = 0, 0
    for bound, words in sorted(map(tuple, counts.groupBy(level.alias("level")).count().collect()), reverse=True):
        found += words
        if found >= most:
            break
    top = counts.where(level >= bound).orderBy(F.desc("n"), "word").limit(most)
    return [r["word"] for r in top.collect()]


def redact(text: str, mask: str = "[SECRET]", min_log10: float = 10.0, prices: Prices = _LIST) -> str:
    """``text`` with the secrets themselves (of an assignment, its value) masked."""
    out, at = [], 0
    for a, b in sorted((s[3], s[4]) for s in scan(text, min_log10, prices)):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_log10: float = 10.0, words: list[str] | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans``;
    ``words`` (by falling count) are counted in the texts if not given."""
    bounded_batches(docs.sparkSession)
    words = corpus_words(docs, text_col) if words is None else words
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def each(batches):
        prices = Prices(words)
        for b in batches:
            found = [scan(t, min_log10, prices) for t in text_of(b)]
            counts = [pa.array([sum(s[0] == k for s in f) for f in found], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(_joined([s for s in f if s[0] != "guess"]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array(digests, pa.string()),
                 pa.array([_joined(f) for f in found], pa.string())], names)

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(each, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                           + ", base_sha256 string, spans string")


def redact_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
                     min_log10: float = 10.0, words: list[str] | None = None) -> DataFrame:
    """``docs`` with its columns and rows, secrets masked in the text; the
    character count of a changed text is set anew.  ``words`` as in
    ``find_secrets``; ``docs`` should be a written table, as it is read twice."""
    bounded_batches(docs.sparkSession)
    words = corpus_words(docs, text_col) if words is None else words
    at = docs.columns.index(text_col)
    chars_at = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def each(batches):
        prices = Prices(words)
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t if t is None else redact(t, min_log10=min_log10, prices=prices) for t in old]
            b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            if chars_at is not None:
                field = b.schema.field(chars_at)
                was = b.column(chars_at).to_pylist()
                b = b.set_column(chars_at, field, pa.array(
                    [c if x == y else len(y) for c, x, y in zip(was, old, new)], field.type))
            yield b

    return docs.mapInArrow(each, docs.schema)
