"""Personal data by candidate gradient boosting, in DataFrame functions.

Generators propose spans, kind by kind; they may overlap.

* Base kinds: ``email``, ``ip``, ``card`` and ``phone``, each the leftmost
  non-overlapping matches of its pattern that pass its check (parts at most
  255; 16 to 19 digits that pass Luhn; 8 to 15 digits).  They always stay.
* High-recall kinds: ``contact`` (addresses that spell out "at" and "dot") and
  ``number`` (any run of seven or more digits with separators).

Every high-recall candidate that touches no base span gets features of its
format (digits, groups, separators, plus sign, Luhn) and of its context (words
before it, signs around it, letters that touch it).  Boosted trees, fitted when the
query starts on a labelled table of candidates in context, give a probability.
The table crosses contexts of several languages with formats: a phone's format
behind a phone's context is right, an account's behind an account's, a date
behind either is wrong, and so is anything behind an order or a page.  A quarter
of the contexts and a quarter of the formats are kept out of the fit; on rows
with one of them a threshold is calibrated for each kind: the lowest score from
which on the share of right candidates is at least ``precision``.  The trees
that are used then see the whole table.

Places: a pattern's matches and the pieces between them come from one pattern
each; a match starts at the summed code points of what lies before it, a
window sum over the matches of one text.  The patterns take possessive
repeats and start only where a run starts, which finds the same matches in
time linear in the text and without recursion in the pattern engine.

Defined cases: null text counts as empty; a text without spans has zero
counts, the SHA-256 of nothing, and an empty span list; rows that repeat an id
are scanned each on their own; texts of any length are scanned whole; spans that
start together come in the order of their kinds; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

# fixed values: patterns of the kinds (base kinds first, in their order)
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "contact": rf"(?i)(?<!{_LOCAL}){_LOCAL}++(?:\x20?[\[({{]at[\])}}]\x20?|\x20at\x20)[a-z0-9-]++"
               r"(?:(?:\x20?[\[({]dot[\])}]\x20?|\x20dot\x20|\.)[a-z0-9-]++)++",
    "number": r"(?<![0-9])[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("contact", "number")
#: characters of context on either side
CONTEXT = 32

# fixed values: context words and what they speak for
WORDS = {
    "w_phone": "phone|tel|telefon|téléphone|teléfono|mobile|mobil|cell|fax|call|whatsapp|sms|ruf|handy|appelez|portable|"
               "móvil|mon numéro|mi número|my number|text me|ring me|llama",
    "w_money": "card|visa|mastercard|amex|iban|account|konto|compte|cuenta|credit|debit",
    "w_person": "ssn|social security|passport|reisepass|passeport|pasaporte|licence|license no|born|dob|patient|tax id",
    "w_mail": "mail|e-mail|email|contact|kontakt|correo|write to|reach",
    "w_other": "order|invoice|isbn|issn|version|ref|page|vol|figure|doi|serial|part|model|population|http|www|id=|bestell|"
               "rechnung|seite|artikel|commande|facture|pedido|factura|página|item|sku|build|error|line|since|between",
}


def _guard(kind: str) -> Column:
    """A cheap condition that any match of ``kind`` implies."""
    text = F.col("text")
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "contact":
        return text.rlike(r"(?i)[\x20\[({]at[\])}\x20]") & text.rlike(r"(?i)dot|\.")
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, found``: every row's candidates of all kinds, with the
    code points before each and its context."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    rows = rows.select("*", *[
        F.when(_guard(k), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}")
        for k, p in PATTERNS.items()])
    rows = rows.select("*", *[
        F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).otherwise(none).alias(f"p_{k}")
        for k, p in PATTERNS.items()])

    def listed(k):
        m, p = F.col(f"m_{k}"), F.col(f"p_{k}")
        return F.when(F.size(m) > 0, F.transform(F.sequence(F.lit(0), F.size(m) - 1), lambda i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), F.length(p[i]).cast("long").alias("gap"), m[i].alias("match"),
            F.right(p[i], F.lit(CONTEXT)).alias("before"), F.left(p[i + 1], F.lit(CONTEXT)).alias("after"))))

    empty = "array<struct<kind:string,i:int,gap:bigint,match:string,before:string,after:string>>"
    return rows.select("row", "doc_id", F.concat(*[F.coalesce(listed(k), F.array().cast(empty)) for k in PATTERNS])
                       .alias("found"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def base_check() -> Column:
    """Whether a base candidate passes its kind's check."""
    m = F.col("match")
    # without leading zeros, a part of more than three digits is above 255
    octets = F.forall(F.split(m, r"\."), lambda x: F.when(
        F.length(F.regexp_replace(x, "^0+", "")) <= 3,
        F.concat(F.lit("0"), F.regexp_replace(x, "^0+", "")).cast("int") <= 255).otherwise(F.lit(False)))
    count = F.length(_digits(m))
    return (F.when(F.col("kind") == "ip", octets)
            .when(F.col("kind") == "card", count.between(16, 19) & F.call_function("luhn_check", _digits(m)))
            .when(F.col("kind") == "phone", count.between(8, 15))
            .otherwise(F.col("kind") == "email"))


FEATURES = ("digits", "chars", "groups", "spaces", "dashes", "dots", "slashes", "parens", "longest", "luhn",
            "year", "distinct", "round", "spelled", "domain", "contact", "brackets", "touch_before", "touch_after", "plus_before", "currency", "decimal",
            *WORDS)


def with_features(df: DataFrame) -> DataFrame:
    """``df`` (kind, match, before, after) with ``FEATURES`` as doubles."""
    m, before, after = F.col("match"), F.lower("before"), F.lower("after")
    around = F.concat(before, F.lit(" "), F.left(after, F.lit(12)))

    def many(pattern):
        return F.regexp_count(m, F.lit(pattern))

    runs = F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))
    cols = {
        "digits": many("[0-9]"), "chars": F.length(m), "groups": F.size(runs), "spaces": many("\\x20"),
        "dashes": many("-"), "dots": many("\\."), "slashes": many("/"), "parens": many("[()]"),
        "longest": F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0)),
        "luhn": F.when(many("[0-9]").between(13, 19), F.call_function("luhn_check", _digits(m))).otherwise(F.lit(False)),
        "year": m.rlike("(?:^|[^0-9])(?:19|20)[0-9]{2}(?:[^0-9]|$)"),
        "distinct": F.size(F.array_distinct(F.split(_digits(m), ""))),
        "round": m.rlike("(?:^|[^0-9])0{3,}$|0{4,}$"), "spelled": m.rlike(r"(?i)[\x20\[({]dot[\x20\])}]"),
        "domain": m.rlike(r"(?i)(?:\.|dot[\])}]?\x20?)(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|nl|at|ch)$"),
        "contact": F.col("kind") == "contact", "brackets": m.rlike("[\\[({]"),
        "touch_before": before.rlike("[a-z0-9_=#]$"), "touch_after": after.rlike("^[a-z0-9_%]"),
        "plus_before": before.rlike("\\+$"), "currency": around.rlike("[$€£]|usd|eur"),
        "decimal": before.rlike("[0-9][.,]$") | after.rlike("^[.,][0-9]"),
        **{name: before.rlike(rf"\b(?:{words})") for name, words in WORDS.items()},
    }
    return df.select("*", *[c.cast("double").alias(f"f_{k}") for k, c in cols.items()])


# fixed values: the labelled table, as contexts times formats
_PHONE_CONTEXT = ["phone: ", "Tel. ", "Tel: ", "tel ", "Telefon ", "Telefon: ", "call me on ", "call ", "Ruf mich an: ",
                  "Rufnummer ", "ruf an unter ", "my mobile is ", "Mobil: ", "Handy ", "Handynummer: ", "cell ", "fax ", "Fax: ",
                  "WhatsApp ", "SMS an ", "mi número es ", "mi teléfono es ", "teléfono ", "móvil ", "llama al ",
                  "mon numéro est le ", "appelez le ", "téléphone : ", "portable ", "text me at ", "my number is ", "ring me: "]
_PHONE_FORMAT = ["555-867-5309", "(020) 7946 0958", "06 12 34 56 78", "030 9018 2000", "0912 345 678", "0171/5550123",
                 "030/1234567", "030 7654321", "0151-23456789", "612 345 678", "07700 900123", "212.555.0187", "1-800-555-0199",
                 "0041 44 668 18 00", "91 234 56 78", "4479460958", "(0211) 123-4567", "0664 / 123 45 67"]
_ACCOUNT_CONTEXT = ["card no ", "Visa ", "IBAN ", "account ", "account no. ", "my account is ", "SSN ", "passport no ", "Konto ",
                    "Kontonummer: ", "credit card ", "compte ", "cuenta ", "Reisepass ", "pasaporte ", "tax id ", "patient ", "driver licence no "]
_ACCOUNT_FORMAT = ["4111 1111 1111 1112", "5500-0000-0000-0005", "078-05-1120", "370400440532013000", "12345678", "87654321",
                   "00012345678", "1002 3456 78", "3782 822463 10006", "9034751826", "44 81 90 17 22"]
_WRONG_CONTEXT = ["order ", "ISBN ", "version ", "invoice ", "page ", "population ", "in ", "the total of ", "serial ",
                  "ref ", "about ", "model ", "id=", "www.site/", "Figure ", "and the ", "Bestellung ", "Rechnung ", "Seite ",
                  "commande ", "facture ", "pedido ", "factura ", "item ", "sku ", "build ", "error ", "line ", "between ",
                  "since ", "von ", "en ", "Artikel "]
_WRONG_FORMAT = ["2019-04-05", "1234567", "978-3-16-148410-0", "10.1000/182", "1998 2003", "20190405120000",
                 "3.14159265", "12/05/2011", "0000000000", "100 000 000", "05.04.2019 12", "1.000.000", "1 2 3 4 5 6 7",
                 "2001/02/03", "1999-2000"]
_MAIL_CONTEXT = ["mail ", "write to ", "contact ", "so ", "reach me: ", "then ", "and ", "Kontakt: ", "correo ", "e-mail: "]
_MAIL = ["john.doe at example dot com", "anna (at) mail.org", "info [at] firm [dot] de", "max{at}web{dot}net",
         "jean.petit (at) poste dot fr", "office [at] school.edu", "a.b at c dot org", "sales(at)shop(dot)com"]
_NO_MAIL_CONTEXT = ["he ", "she ", "we ", "so ", "mail ", "then ", "and ", "they ", "it "]
_NO_MAIL = ["arrived at noon.the", "was at home.but", "looked at it.then", "stayed at work.after", "laughed at him.so",
            "is at risk.this", "came at dawn.nobody", "sold at cost.all"]


def labelled(spark: SparkSession) -> DataFrame:
    """The labelled candidates: kind, match, before, after, label."""
    def rows(kind, contexts, formats, label):
        return (spark.range(1).select(F.explode(F.array(*map(F.lit, contexts))).alias("before"))
                .select("before", F.explode(F.array(*map(F.lit, formats))).alias("match"))
                .select(F.lit(kind).alias("kind"), "match", "before", F.lit(" and so on").alias("after"),
                        F.lit(float(label)).alias("label")))
    return reduce(DataFrame.unionByName, [
        rows("number", _PHONE_CONTEXT, _PHONE_FORMAT, 1), rows("number", _ACCOUNT_CONTEXT, _ACCOUNT_FORMAT, 1),
        rows("number", _WRONG_CONTEXT, _WRONG_FORMAT + _PHONE_FORMAT + _ACCOUNT_FORMAT, 0),
        rows("number", _PHONE_CONTEXT + _ACCOUNT_CONTEXT, _WRONG_FORMAT, 0),
        rows("contact", _MAIL_CONTEXT, _MAIL, 1), rows("contact", _NO_MAIL_CONTEXT, _NO_MAIL, 0)])


def _folds(table: DataFrame) -> DataFrame:
    """``table`` with ``held``: whether its context or its format is kept out of the fit."""
    fold = [F.pmod(F.xxhash64(F.lit("fold"), c), F.lit(4)) for c in ("before", "match")]
    return table.withColumn("held", (fold[0] == 0) | (fold[1] == 0))


def _fitted(rows: DataFrame, rounds: int, depth: int, seed: int):
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32, minInstancesPerNode=2).fit(rows)


def _calibrated(spark: SparkSession, precision: float, rounds: int, depth: int, seed: int):
    """Assembler, the labelled table, the trees of the rows that are not held, and
    the threshold of each added kind on those that are."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    assembler = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")
    table = written(assembler.transform(with_features(_folds(labelled(spark)))).select(
        "kind", "label", "features", "held").coalesce(1), "labelled")
    model = _fitted(table.where("NOT held"), rounds, depth, seed)
    scored = (model.transform(table.where("held"))
              .select("kind", "label", vector_to_array("probability")[1].alias("p")))
    down = Window.partitionBy("kind").orderBy(F.desc("p")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    limits = (scored.withColumn("share", F.avg("label").over(down))
              .where(F.col("share") >= precision).groupBy("kind").agg(F.min("p").alias("p")))
    found = {r["kind"]: r["p"] for r in limits.collect()}
    return assembler, table, model, {k: max(0.5, found.get(k, 1.1)) for k in ADDED}


def train(spark: SparkSession, rounds: int = 16, depth: int = 5, precision: float = 0.95, seed: int = 3):
    """The boosted trees and the threshold of each added kind: calibrated on the
    rows held out, then fitted anew on the whole table."""
    assembler, table, _, limits = _calibrated(spark, precision, rounds, depth, seed)
    return assembler, _fitted(table, rounds, depth, seed), limits


def held_out_quality(spark: SparkSession, precision: float = 0.95) -> DataFrame:
    """``kind, n, recall, precision`` on the labelled rows whose context or
    format was not in the fit."""
    from pyspark.ml.functions import vector_to_array

    _, table, model, limits = _calibrated(spark, precision, 16, 5, 3)
    limit = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {float(t)}D" for k, t in limits.items()) + " END")
    rows = model.transform(table.where("held"))
    said = vector_to_array("probability")[1] >= limit
    right = F.col("label") == 1
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), (F.count_if(said & right) / F.count_if(right)).alias("recall"),
                                    (F.count_if(said & right) / F.greatest(F.count_if(said), F.lit(1))).alias("precision"))


def _clear(loose: DataFrame, base: DataFrame) -> DataFrame:
    """Rows of ``loose`` that touch no span of ``base`` of the same text: in order
    of starts, no base span before ends behind the start, and none after
    starts before the end.  One sort of each text's spans, however many."""
    both = (loose.withColumn("given", F.lit(False))
            .unionByName(base.select("row", "start", "end").withColumn("given", F.lit(True)), allowMissingColumns=True))
    so_far = (Window.partitionBy("row").orderBy("start", F.desc("given"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    from_here = (Window.partitionBy("row").orderBy(F.desc("start"), "given")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = F.max(F.when(F.col("given"), F.col("end"))).over(so_far)
    starts = F.min(F.when(F.col("given"), F.col("start"))).over(from_here)
    return (both.withColumn("ends", ends).withColumn("starts", starts)
            .where(~F.col("given") & (F.coalesce("ends", F.lit(0)) <= F.col("start"))
                   & (F.col("starts").isNull() | (F.col("starts") >= F.col("end"))))
            .drop("given", "ends", "starts"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       precision: float = 0.95) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_contact, n_number,
    base_sha256, spans``, one row per input row."""
    from pyspark.ml.functions import vector_to_array

    spark = docs.sparkSession
    assembler, model, thresholds = train(spark, precision=precision)
    rows = written(candidates(docs, id_col, text_col), "candidates")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (rows.where(F.size("found") > 0).select("row", F.explode("found").alias("c")).select("row", "c.*")
             .withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
             .withColumn("start", F.col("end") - F.length("match")))
    order = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(PATTERNS)) + " END")
    base = found.where(F.col("kind").isin(*BASE)).where(base_check())
    spans = written(base.select("row", "kind", "start", "end"), "base-spans")
    clear = _clear(found.where(F.col("kind").isin(*ADDED)), spans)
    limit = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {float(t)}D" for k, t in thresholds.items()) + " END")
    chosen = (model.transform(assembler.transform(with_features(clear)))
              .where(vector_to_array("probability")[1] >= limit).select("row", "kind", "start", "end"))
    named = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    per_row = (spans.unionByName(chosen).select("row", F.struct(order.alias("o"), "start", "end", "kind",
                                                                named.alias("name")).alias("s"))
               .groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("s"),
                                   *[F.count_if(F.col("s.kind") == k).alias(f"n_{k}") for k in PATTERNS]))
    only_base = F.filter("s", lambda x: x["o"] < len(BASE))

    def joined(spans_):
        return F.coalesce(F.array_join(F.transform(spans_, lambda x: x["name"]), ","), F.lit(""))

    return (rows.select("row", "doc_id").join(per_row, "row", "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in PATTERNS],
                    F.sha2(joined(only_base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans")))
