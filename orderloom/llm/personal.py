"""Personal data: four plain patterns, and candidates that boosted trees judge by their form and what stands around them.

The plain patterns (email, ip, card, phone) are matched leftmost and whole; what fails its test is dropped.  Generators of
high recall then propose more spans, which may overlap: written-out mail addresses, numbers grouped like local telephone
numbers or national ids, account numbers, and groups of hex digits.  Gradient-boosted trees (MLlib) score a candidate
from its format and from the text before and after it.  They are taught by values of known kind, and look-alikes, set
into places of every text of the table, which together cover it; what the texts hold by themselves counts as doubtful and
has a low weight.  Equal examples are counted, and the splits of the trees are chosen among all values that occur.  On
places that the trees have not seen, scores are pooled into a monotone precision by kind, and the lowest score that
reaches PRECISION is the kind's threshold.  The fitted trees become CASE expressions, so that texts are scored where they
lie.  All is SQL functions and MLlib.

Places are code points, end exclusive.  A chosen candidate that overlaps a plain match is left out, as is one that
overlaps a candidate of a higher score.  Null and empty texts have no spans; texts are read whole; equal rows give equal
results; a table without any text, or an empty one, has plain spans only (it has nothing to teach with); columns named
like a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Workspace, whole_text, without

# The possessive forms take what the plain ones take, without backtracking or recursion on long runs.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-](?:[\x20().-]*+[0-9])++"
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"

KINDS = ("email", "ip", "card", "phone", "written_email", "local_phone", "national_id", "iban", "ipv6")
PLAIN = 4
_AT, _DOT = r"(?i:[(\[{<]\x20?at\x20?[)\]}>]|(?<=\x20)at(?=\x20))", r"(?i:[(\[{<]\x20?dot\x20?[)\]}>]|(?<=\x20)dot(?=\x20)|\.)"
#: (kind, what a text must hold to be searched, candidates, what a candidate must satisfy)
GENERATORS = (
    (4, _AT, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++\x20?{_AT}\x20?[A-Za-z0-9-]++(?:\x20?{_DOT}\x20?[A-Za-z0-9-]++)++", None),
    (5, "[0-9](?:[^0-9A-Za-z]{0,2}[0-9]){6}", r"(?<![0-9A-Za-z.,+])\(?[0-9]++(?:[\x20().\-/]{1,2}+[0-9]++)*+", (7, 15)),
    (6, "[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}", r"(?<![0-9-])[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}(?![0-9-])", None),
    (7, "[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None),
    (8, ":[0-9A-Fa-f]{0,4}:", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", None),
)

BEFORE, AFTER = 40, 12  # characters of context
PLACES = 8  # examples from each text, more from one that so many do not cover
WINDOW = 120  # characters on either side of an example
TREES, DEPTH = 15, 4
PRECISION = 0.9
BINS = 100
CHUNK = 64

_PHONES = ("phone:", "Tel.", "call me at", "mobile", "reach us on", "fax", "telefon", "WhatsApp")
_IDS = ("SSN", "social security number", "national id:", "passport no.", "tax id", "identity card")
_BANKS = ("IBAN", "bank account:", "pay to", "Konto", "account no.")
_MAILS = ("mail", "write to", "contact:", "e-mail me:", "reach me:")
_HOSTS = ("address", "host", "from", "client ip", "connected to")
_OTHERS = ("order", "invoice no.", "ref", "total", "version", "ISBN", "pages", "figure", "$", "EUR", "sku", "item", "in", "population", "at", "the")
#: (kind or None for a look-alike, cues, share of examples with a cue in tenths, forms: # digit, * letters, ^ hex digit, %% check digits)
EXAMPLES = (
    (5, _PHONES, 7, ("(###) ###-####", "###-###-####", "###.###.####", "0## #### ####", "(0##) ### ## ##")),
    (5, _PHONES, 10, ("### ### ###", "### ####", "###-####", "##########", "0### ######")),
    (6, _IDS, 8, ("###-##-####", "### ## ####")),
    (7, _BANKS, 6, ("DE%% #### #### #### #### ##", "DE%%##################")),
    (4, _MAILS, 6, ("*.* at * dot com", "* at * dot org", "* (at) * (dot) org", "*[at]*.net", "*## [at] * [dot] de", "*.*(at)*.com")),
    (8, _HOSTS, 6, ("2001:^^^^:^^^^:^^^^:^^^^:^^^^:^^^^:^^^^", "fe80::^^^^:^^^^:^^^^:^^^^")),
    (None, _OTHERS, 9, ("#########", "##########", "#######", "### ### ###", "####-######", "###-###", "###-####", "########-##")),
    (None, _OTHERS, 5, ("20##-0#-1#", "1#/0#/20##", "#.########", "978-#-##-######-#", "1###-1###", "20##-1#-2# 1#")),
    (None, _PHONES + _OTHERS, 5, ("################", "#### #### #### ####", "20##-0#-1#", "1#.0#.20##")),
    (None, _BANKS + _OTHERS, 5, ("DE## #### #### #### #### ##", "AB## #### ####", "XY##################")),
    (None, _MAILS + _OTHERS, 5, ("* at *. *", "* at *.*", "* at *. * *", "* (at) * *")),
    (None, _HOSTS + _OTHERS, 5, ("1#:2#:3#", "#:##:##", "##:0#:1#", "1:#:#")),
)

SPAN = "array<struct<kind:int,start:int,end:int>>"
FOUND = "array<struct<kind:int,start:int,end:int,match:string,before:string,after:string>>"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _places(text: Column, pattern: str, kind: int) -> Column:
    """All matches with their places and the text between them, without copying what came before."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        def of(p: Column) -> Column:
            steps = F.transform(m, lambda x, i: F.length(x) + F.length(F.get(p, i)))

            def ends(s: Column) -> Column:
                chunks = F.sequence(F.lit(0), F.floor((F.size(m) - 1) / CHUNK).cast("int"))
                sums = F.transform(chunks, lambda k: _sum(F.slice(s, k * CHUNK + 1, F.lit(CHUNK))))
                offsets = _let(sums, lambda t: F.transform(chunks, lambda k: _sum(F.slice(t, F.lit(1), k))))

                def all_of(o: Column) -> Column:
                    def one(x: Column, i: Column) -> Column:
                        chunk = F.floor(i / CHUNK).cast("int")
                        end = F.get(o, chunk) + _sum(F.slice(s, chunk * CHUNK + 1, i - chunk * CHUNK + 1))
                        return F.struct(
                            F.lit(kind).alias("kind"), (end - F.length(x)).alias("start"), end.alias("end"), x.alias("match"),
                            F.substring(F.get(p, i), -BEFORE, BEFORE).alias("before"), F.substring(F.get(p, i + 1), 1, AFTER).alias("after"),
                        )

                    return F.transform(m, one)

                return _let(offsets, all_of)

            return _let(steps, ends)

        return F.when(F.size(m) > 0, _let(pieces, of)).otherwise(F.array().cast(FOUND))

    return _let(matches, placed)


def _none(kind: str = FOUND) -> Column:
    return F.array().cast(kind)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return _sum(F.transform(F.sequence(F.lit(1), F.length(digits)), value)) % 10 == 0


def _plain(t: Column) -> Column:
    """The spans of the four plain kinds, in order of kind, then start."""
    found = lambda pattern, kind, guard, keep: F.when(guard, F.filter(_places(t, pattern, kind), keep)).otherwise(_none())
    between = lambda n, low, high: (n >= low) & (n <= high)
    card = lambda x: between(F.length(x["match"]), 13, 37) & _let(_digits(x["match"]), lambda d: between(F.length(d), 13, 19) & F.when(between(F.length(d), 13, 19), _luhn(d)).otherwise(F.lit(False)))
    spans = F.concat(
        found(EMAIL, 0, t.contains("@"), lambda x: F.lit(True)),
        found(IP, 1, t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda x: x["match"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        found(CARD, 2, t.rlike(r"(?:[0-9][\x20-]?){12}[0-9]"), card),
        found(PHONE, 3, t.contains("+") & t.rlike(r"\+[0-9]"), lambda x: between(F.length(_digits(x["match"])), 9, 15)),
    )
    return F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).cast(SPAN)


def _candidates(t: Column) -> Column:
    """What the generators propose; spans of different kinds may overlap."""
    out = []
    for kind, guard, pattern, digits in GENERATORS:
        found = _places(t, pattern, kind)
        if digits:
            low, high = digits
            found = F.filter(found, lambda x: F.length(_digits(x["match"])).between(low, high))
        out.append(F.when(t.rlike(guard), found).otherwise(_none()))
    return F.concat(*out)


def _mod97(match: Column) -> Column:
    """Whether the check digits of an account number are right."""
    s = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(s, 5, 40), F.substring(s, 1, 4))
    number = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))
    return F.aggregate(F.split(F.array_join(number, ""), ""), F.lit(0), lambda a, c: (a * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97) == 1


def _cue(words: tuple[str, ...], near: str = r"[^A-Za-z0-9]{0,4}") -> str:
    return rf"(?i)(?:^|[^A-Za-z])(?:{'|'.join(words)}){near}$"


FEATURES = tuple(k for k in KINDS[PLAIN:]) + (
    "digits", "letters", "groups", "longest", "first", "last", "parenthesis", "hyphen", "dot", "space", "slash", "bracketed", "dot_word", "domain", "colons", "hex_letters", "check", "date", "leading_zero", "distinct_digits",
    "phone_cue", "id_cue", "bank_cue", "mail_cue", "host_cue", "other_cue", "joined_before", "joined_after", "money_after",
)


def _features(x: Column) -> Column:
    """array<double> of FEATURES from a candidate's format and context."""
    m, b, a = x["match"], x["before"], x["after"]
    runs = lambda s: F.filter(F.split(s, "[^0-9]+"), lambda r: r != "")
    yes = lambda c: F.when(c, 1.0).otherwise(0.0)
    count = lambda pattern: F.length(F.regexp_replace(m, pattern, ""))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    values = [yes(x["kind"] == k) for k in range(PLAIN, len(KINDS))]
    values += [number(count("[^0-9]+")), number(count("[^A-Za-z]+")), number(F.size(runs(m))), number(F.array_max(F.transform(runs(m), F.length))), number(F.length(F.get(runs(m), 0))), number(F.length(F.element_at(runs(F.concat(F.lit("0 "), m)), -1)))]
    values += [yes(m.contains(c)) for c in ("(", "-", ".", " ", "/")]
    values += [yes(m.rlike(r"[(\[{<]")), yes(m.rlike(r"(?i)dot")), yes(m.rlike(r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|pl|uk|eu)$")), number(count("[^:]+")), number(count("[^A-Fa-f]+"))]
    values += [yes(F.when(x["kind"] == 7, _mod97(m)).otherwise(F.lit(False))), yes(m.rlike(r"^(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)?[0-9]{2})(?![0-9])")), yes(m.rlike(r"^\(?0")), number(F.size(F.array_distinct(F.split(_digits(m), ""))))]
    values += [
        yes(b.rlike(_cue((r"phone", r"tel(?:efon|\.)?", r"call(?:\x20me)?(?:\x20at|\x20on)?", "mobile", "cell", "fax", "whatsapp", r"reach\x20(?:us|me)\x20(?:on|at)", "sms", "contact")))),
        yes(b.rlike(_cue(("ssn", r"social\x20security(?:\x20number)?", r"(?:national|tax)\x20id", r"passport(?:\x20no\.)?", r"identity\x20card", r"id\x20number")))),
        yes(b.rlike(_cue(("iban", r"(?:bank\x20)?account(?:\x20no\.)?", r"pay\x20to", "konto")))),
        yes(b.rlike(_cue((r"e?-?mail(?:\x20me)?", r"write\x20to", "contact", r"reach\x20(?:me|us)")))),
        yes(b.rlike(_cue(("address", "host", "from", r"ip(?:v6)?", r"connected\x20to")))),
        yes(b.rlike(_cue(("order", "invoice", r"no\.?", "ref", "total", "version", "isbn", "pages?", "figure", "sku", "item", "population", "eur", "usd"), r"[^A-Za-z0-9]{0,3}")) | b.rlike(r"[$€£#]\x20?$")),
        yes(b.rlike("[A-Za-z0-9_]$")), yes(a.rlike("^[A-Za-z0-9_]")), yes(a.rlike(r"^\x20?(?:[$€£%]|EUR|USD)")),
    ]
    return F.array(*[v.cast("double") for v in values])


def _across(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _examples(documents: DataFrame, text: str) -> DataFrame:
    """(planted, truth, from, until, fold): the places of every text, with a value of known kind set into each."""
    texts = documents.select(whole_text(text).alias("t")).where("t != ''").withColumn("h", F.xxhash64(F.lit(13), "t"))
    texts = texts.dropDuplicates(["h"])  # copies lend no places of their own
    size, n = 2 * WINDOW, F.length("t")
    spread = F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda k: F.substring("t", F.floor(k * F.greatest(n - size, F.lit(0)) / (PLACES - 1)).cast("int") + 1, F.lit(size)))
    tiled = F.regexp_extract_all("t", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    rows = texts.select("h", F.posexplode(F.when(n > PLACES * size, tiled).otherwise(spread)).alias("k", "place"))
    rows = rows.select("place", *[F.xxhash64(F.lit(i), "k", "h").alias(f"h{i}") for i in range(6)])
    pick = lambda h, n: F.pmod(F.col(h), F.lit(n)).cast("int")
    lines = F.array(*[F.struct(F.lit(-1 if k is None else k).alias("truth"), F.array(*map(F.lit, cues)).alias("cues"), F.lit(share).alias("share"), F.array(*map(F.lit, forms)).alias("forms")) for k, cues, share, forms in EXAMPLES])
    rows = rows.withColumn("line", F.get(lines, pick("h0", len(EXAMPLES))))
    rows = rows.select(
        "*", F.get("line.forms", F.pmod("h1", F.size("line.forms").cast("long")).cast("int")).alias("form"),
        F.when(pick("h2", 10) < F.col("line.share"), F.concat(F.get("line.cues", F.pmod(F.shiftright("h2", 8), F.size("line.cues").cast("long")).cast("int")), F.lit(" "))).otherwise(F.lit("")).alias("cue"),
        F.concat(*[F.lpad(F.pmod(F.col(h), F.lit(10**15)).cast("string"), 15, "0") for h in ("h3", "h4", "h5")]).alias("d"), F.sha2(F.concat("h3", F.lit(" "), "h4"), 256).alias("x"),
    )
    letter = F.translate(F.substring("d", 1, 45), "0123456789", "bdeiklnors")
    fill = lambda c, i: F.when(c == "#", F.substring("d", i + 1, F.lit(1))).when(c == "*", F.substring(letter, i + 1, 3 + F.pmod(F.shiftright("h4", 8) + i, F.lit(8)).cast("int"))).when(c == "^", F.substring("x", i + 1, F.lit(1))).otherwise(c)
    rows = rows.withColumn("value", F.array_join(F.transform(F.split("form", ""), fill), ""))
    body = F.regexp_replace(F.substring("value", 5, 40), r"\x20", "")
    check = F.lpad((98 - F.pmod(F.concat(body, F.lit("131400")).try_cast("decimal(38,0)"), F.lit(97))).cast("int").cast("string"), 2, "0")
    rows = rows.withColumn("value", F.when(F.col("value").contains("%%"), F.concat(F.lit("DE"), check, F.substring("value", 5, 40))).otherwise(F.col("value")))
    left, right = F.substring("place", 1, WINDOW), F.substring("place", WINDOW + 1, WINDOW)
    start = F.length(left) + 1 + F.length("cue")
    return rows.select(F.concat(left, F.lit(" "), "cue", "value", F.lit(" "), right).alias("planted"), F.col("line.truth").alias("truth"), start.alias("from"), (start + F.length("value")).alias("until"), F.pmod("h4", F.lit(10)).alias("fold"))


@dataclass(frozen=True)
class Model:
    trees: tuple  # (weight, node); a node is a value or (feature, threshold, node, node)
    thresholds: tuple[float | None, ...]  # by kind, from PLAIN on; None: never

    def margin(self, f: Column) -> Column:
        def of(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(F.get(f, feature) <= threshold, of(left)).otherwise(of(right))

        total = F.lit(0.0)
        for weight, node in self.trees:
            total = total + weight * of(node)
        return total


def _node(java):
    if java.getClass().getSimpleName() == "LeafNode":
        return float(java.prediction())
    split = java.split()
    return int(split.featureIndex()), float(split.threshold()), _node(java.leftChild()), _node(java.rightChild())


def _trees(model: GBTClassificationModel) -> tuple:
    return tuple((float(w), _node(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees))


def _threshold(bins: list[tuple[int, float, float]]) -> float | None:
    """The lowest margin, 0 at least, whose pooled precision reaches PRECISION; ``bins``: (bin, weight, weight of true ones), rising."""
    blocks: list[list[float]] = []
    for at, n, good in bins:
        blocks.append([at, n, good])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            _, n2, g2 = blocks.pop()
            blocks[-1] = [blocks[-1][0], blocks[-1][1] + n2, blocks[-1][2] + g2]
    return next((max(0.0, _edge(at)) for at, n, good in blocks if good >= PRECISION * n), None)


def _bin(margin: Column) -> Column:
    return F.floor((F.greatest(F.lit(-2.0), F.least(F.lit(2.0), margin)) + 2.0) / 4.0 * BINS).cast("int")


def _edge(at: int) -> float:
    return at / BINS * 4.0 - 2.0


def _bins_for(rows: int) -> int:
    """The least ``maxBins`` with which MLlib looks for splits in all rows: from more than its square it draws a sample."""
    return max(32, math.isqrt(max(0, rows - 1)) + 1)


def fit(documents: DataFrame, text: str = "text") -> Model | None:
    """None where there is no text to teach with."""
    space = Workspace(documents.sparkSession, "personal")
    made = _examples(documents, text).select("*", _plain(F.col("planted")).alias("plain"), _candidates(F.col("planted")).alias("all"))
    # What a plain match takes is never chosen, so there is nothing to learn from it.
    found = made.select("*", F.explode(F.filter("all", lambda c: ~F.exists("plain", lambda b: _across(b, c)))).alias("c"))
    own = (F.col("c.start") < F.col("until")) & (F.col("from") < F.col("c.end"))
    right = (F.col("truth") == F.col("c.kind")) & (F.col("c.start") == F.col("from")) & (F.col("c.end") == F.col("until"))
    rows = found.select("fold", F.col("c.kind").alias("kind"), _features(F.col("c")).alias("f"), F.when(right, 1.0).otherwise(0.0).alias("label"), F.when(own, 1.0).otherwise(0.25).alias("weight"))
    rows = space.keep(rows.groupBy("fold", "kind", "f", "label").agg(F.sum("weight").alias("weight")), "examples")
    n, labels = rows.where("fold < 7").agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    if labels < 2:
        return None
    boosted = GBTClassifier(featuresCol="v", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=_bins_for(n), stepSize=0.3, seed=7)
    model = Model(_trees(boosted.fit(rows.where("fold < 7").select(array_to_vector("f").alias("v"), "label", "weight"))), ())
    seen = rows.where("fold >= 7").select("kind", _bin(model.margin(F.col("f"))).alias("bin"), "label", "weight")
    counts = seen.groupBy("kind", "bin").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("good")).orderBy("kind", "bin").collect()  # at most BINS + 1 for each kind
    return Model(model.trees, tuple(_threshold([(r.bin, r.n, r.good) for r in counts if r.kind == k]) for k in range(PLAIN, len(KINDS))))


def scan(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``found`` array<struct<kind, start, end>>, in order of kind, then start; ``kind`` counts in KINDS."""
    df = without(df, "found", "_t", "_plain", "_more", "_chosen")
    keep = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*keep, whole_text(text).alias("_t"))
    df = df.select("*", _plain(F.col("_t")).alias("_plain"))
    if model is None or not any(t is not None for t in model.thresholds):
        return df.select(*keep, F.sort_array("_plain").alias("found"))
    scored = F.transform(
        F.transform(_candidates(F.col("_t")), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), _features(c).alias("f"))),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), model.margin(c["f"]).alias("score")),
    )
    least = F.array(*[F.lit(t).cast("double") for t in (None,) * PLAIN + model.thresholds])
    df = df.select("*", F.filter(scored, lambda c: F.coalesce(c["score"] >= F.get(least, c["kind"]), F.lit(False))).alias("_more"))
    rank = lambda c: F.struct(c["score"], -c["start"], -c["kind"])
    free = F.filter("_more", lambda c: ~F.exists("_plain", lambda b: _across(b, c)))
    df = df.select("*", free.alias("_chosen"))
    best = F.filter("_chosen", lambda c: ~F.exists("_chosen", lambda o: _across(o, c) & (rank(o) > rank(c))))
    more = F.transform(best, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))).cast(SPAN)
    return df.select(*keep, F.sort_array(F.concat("_plain", more)).alias("found"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with each found span of the text replaced by its kind in brackets; of overlapping spans the first stands for all."""
    columns = df.columns
    body, names = F.col(f"`{text}`"), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    spans = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(body, state["at"] + 1, s["start"] - state["at"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, F.concat(state["out"], gap, F.get(names, s["kind"]))).otherwise(state["out"]).alias("out"))

    cleaned = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body))))
    masked = F.when(F.size("found") > 0, cleaned).otherwise(body)
    return scan(df, model, text).select(*[masked.alias(text) if c == text else F.col(f"`{c}`") for c in columns if c.lower() != "found"])


def report(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    found = scan(df.select("doc_id", F.col(text).alias("text")), model)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < PLAIN)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(PLAIN)], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["kind"] >= PLAIN)).cast("long").alias("n_more"),
    )
