"""Secret scans: candidates by pattern, false positives out by a random forest.

DataFrame operations only. One pattern finds candidates: assignments to names
such as ``password`` or ``token``, private keys from header to end, keys of known
prefixes, and runs of key characters that hold a digit. Splitting a text by the same pattern gives what
stands between, so each candidate comes with its place and neighbours without
any loop. A random forest, trained here on labelled findings (``LABELLED``),
then judges length, mix of character classes and transitions between them,
coverage by dictionary words, place in a path, and the neighbouring words.
"""

from __future__ import annotations

import base64
import hashlib
import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.session import cut, free

NAME = "pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|secret[_-]?key|private[_-]?key|client[_-]?secret|credentials?"
RUN = "A-Za-z0-9+/_\\-"
#: A private key from its header to its end line, with no other such line between; without one, to the end of its base64
#: lines, whose line ends may be escaped. Loops are possessive: those need no stack however long a text is.
_KIND, _GAP = "[A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----", "[\\s\"'>|,\\\\]{1,12}+"
BLOCK = (
    f"-----BEGIN {_KIND}(?:[^-]*+(?:-(?!----)[^-]*+){{0,20}}+-----END {_KIND}"
    f"|(?:\\s{{1,4}}+[A-Z][A-Za-z\\-]{{2,20}}: [^\\n]{{1,200}}+){{0,5}}+(?:{_GAP}[A-Za-z0-9+/]{{32,}}+={{0,2}}+){{1,}}+"
    f"(?:{_GAP}(?:[A-Za-z0-9+/]{{1,31}}+={{1,2}}+|(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{{2,31}}+))?+)?+"
)
#: Keys of known prefixes, with their lengths; they need no digit.
KNOWN = (
    f"(?:AKIA|ASIA)[A-Z0-9]{{16}}(?![{RUN}])|gh[pos]_[A-Za-z0-9]{{36,}}+|github_pat_[A-Za-z0-9_]{{22,}}+|glpat-[A-Za-z0-9_\\-]{{20,}}+|xox[abprs]-[A-Za-z0-9\\-]{{10,}}+"
    "|[sr]k_live_[A-Za-z0-9]{16,}+|sk-(?:[a-z]{2,8}-)?[A-Za-z0-9]{20,}+|AIza[A-Za-z0-9_\\-]{35,}+|npm_[A-Za-z0-9]{36,}+|eyJ[A-Za-z0-9_\\-]{17,}+|SG\\.[A-Za-z0-9_\\-]{22}\\.[A-Za-z0-9_\\-]{43}"
)
CANDIDATE = (
    f"(?i:(?:{NAME})[\"']?[ \\t]{{0,3}}[=:][ \\t]{{0,3}}[\"']?)(?!-----BEGIN )[^\\s\"',;]{{6,}}+"
    f"|{BLOCK}|(?<![{RUN}])(?:{KNOWN})[{RUN}]*+={{0,2}}"
    f"|(?<![{RUN}])(?=[A-Za-z+/_\\-]*+[0-9])[{RUN}]{{12,}}+={{0,2}}"
)
PREFIX = "^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|sk-|AIza|eyJ|npm_|SG)"
SECRET_NEAR = f"(?i)(?:{NAME}|bearer|authorization|key|aws|login)[^A-Za-z]{{0,6}}$"
HARMLESS_NEAR = "(?i)(?:sha-?\\d*|md5|commit|revision|checksum|digest|hash|integrity|etag|uuid|guid|isbn|issn|doi|order|invoice|phone|tel|fax|call|card|account|version|build|serial|ticket|example|sample|test|dummy|fake|placeholder|id|ref|no)[^A-Za-z]{0,6}$"
#: Words that identifiers, paths and placeholders are made of; the longest that fits is taken first.
DICTIONARY = "|".join(sorted(
    """about above abcdef accept access account action active actual added address admin after agent alert alias align allow alpha alternate amount analysis android animation answer apache append apple application apply archive area argument array article asset assign async attach attribute audio author auto avatar
    back background backup balance banner base basic batch before begin bench beta between binary block board body book border bottom branch bridge browser buffer build bundle button bytes cache calendar call camera cancel canvas capture card category center chain change channel chapter character chart check child
    choice city class clean clear click client clock clone close cloud cluster code collection color column command comment commit common company compare compile complete component compress computer config connect console constant contact container content context control convert cookie copy core corner correct count
    country course cover create credit current custom dashboard data database date debug decode default define delete delta demo deploy depth describe design detail device dialog dictionary diff digest direct directory disable discount disk display document domain double download draft draw drive driver dummy duplicate
    edge edit editor effect element email empty enable encode engine enter entity entry error escape event example exception exchange execute exist expand expire export extend extension external extra factor fail fake false family fast feature fetch field figure file filter final find finish first fixed flag flash
    float floor flow focus folder follow font footer force foreign forgot forgotten form format forward found frame free front full function future gallery game gateway general generate global grade gradient grammar graph grid group growth guest guide handle hash head header health height hello help hidden high history
    home host hotel hover html http icon ident image import include incorrect index info inner input insert install instance integer internal invalid invoice item java join jpeg json jump keep kernel label language large last latest launch layer layout learn left legacy length letmein letter level library license light
    limit line link linux list listen little load local location lock login logo long loop lower mail main make manager manual many mapping margin mark market master match matrix maximum meeting member memory menu merge message meta method metric middle migration minimum minute missing mobile mock mode model module
    monitor month mount mouse move movie music name native navigation network news next node none normal note null number object offer office offset online open operation option orange order origin other outer output overlay owner package page paint panel paper parallel param parent parse part partner password passwort path
    pattern payment people percent perform period person phone photo picture pipeline pixel place placeholder plain platform player please plugin point policy pool popup port position post power present preview previous price primary print priority private process product profile program progress project prompt property
    protocol provider proxy public pull push python quality query question queue quick quit qwerty radio random range rank rate react read ready reason rebuild receive recent record redirect reference region register relation release remote remove rename render repeat replace reply report request required reset resize
    resource response rest restore result return reverse review right role room root rotate round route router ruby rule running safe sale sample save scale scan schedule schema school scope score screen script scroll search season second secret section secure select send sense sequence serial series server service session
    setting setup shadow shape share sheet shell shift shop short shot show side sign simple single site size skip slide small smart snapshot social socket solution sort sound source space special speed split sport spring stack staff stage standard start state static station status step stop storage store story stream
    street string strong struct student studio style subject submit success suffix summary super support switch symbol sync system table target task team template term test text theme thread thumb ticket time title todo token tool topic total touch tower town trace track train transfer transform travel tree trigger true
    trunk type undefined under union unique unit unknown unlock update upgrade upload upper user utility valid value variable vector vendor verify version vertical video view virtual visit voice volume wait wall warning watch water weather week weight welcome white widget width window winter wire within word work world
    wrap wrong xxxx year yellow yesterday your zero zone 12345 00000""".split(),
    key=lambda w: (-len(w), w),
))
FEATURES = ["length", "digits", "upper", "lower", "symbols", "distinct", "transitions", "hex", "decimal", "uuid", "words", "prefix", "path", "near_secret", "near_harmless", "assigned", "quoted", "header"]
TREES, DEPTH, SEED = 24, 8, 11
THRESHOLD = 0.5
MASK = "[SECRET]"
#: Secrets (24 bytes each) up to which the places of all of them are broadcast; beyond, they are joined, equal texts in so many parts.
BROADCAST_SECRETS, SALTS = 500_000, 32


def candidates(docs: DataFrame) -> DataFrame:
    """A row per candidate: ``doc_id, key`` (hash of the text), ``n, start, found, before, after``.

    ``start`` counts code points from 0. Null and empty texts have none.
    """
    text = docs.select("doc_id", F.xxhash64("text").alias("key"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    text = text.filter(F.size("found") > 0)
    long = lambda a, n: F.aggregate(F.slice(a, 1, n), F.lit(0), lambda s, x: s + F.length(x))
    each = F.transform("found", lambda m, i: F.struct((i + 1).alias("n"), (long(F.col("gaps"), i + 1) + long(F.col("found"), i)).alias("start"), m.alias("found"), F.right(F.get("gaps", i), F.lit(40)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(20)).alias("after")))
    return text.select("doc_id", "key", F.explode(each).alias("c")).select("doc_id", "key", "c.*")


def features(found: DataFrame) -> DataFrame:
    """Add ``value`` (the candidate without name and sign) and the columns of ``FEATURES``."""
    assigned = f"(?i)^(?:{NAME})[\"']?[ \\t]*[=:]"
    found = found.withColumn("assigned", F.col("found").rlike(assigned).cast("double"))
    found = found.withColumn("value", F.when(F.col("assigned") == 1, F.regexp_replace("found", f"{assigned}[ \\t]*[\"']?", "")).otherwise(F.col("found")))
    v = F.col("value")
    size = F.greatest(F.length(v), F.lit(1)).cast("double")
    share = lambda p: F.regexp_count(v, F.lit(p)) / size
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.withColumns({
        "length": size,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "symbols": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / size,
        "transitions": share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "hex": flag(v.rlike("^[0-9a-fA-F]+$")),
        "decimal": flag(v.rlike("^[0-9+_\\-]+$")),
        "uuid": flag(v.rlike("(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
        "words": 1 - F.length(F.regexp_replace(F.lower(v), DICTIONARY, "")) / size,
        "prefix": flag(v.rlike(PREFIX)),
        "path": flag(v.rlike("/[^/]*/") | F.col("before").rlike("[/.@]$") | F.col("after").rlike("^[/@]|^\\.[A-Za-z]")),
        "near_secret": flag(F.col("before").rlike(SECRET_NEAR)),
        "near_harmless": flag(F.col("before").rlike(HARMLESS_NEAR)),
        "quoted": flag(F.col("found").rlike("[\"']") | F.col("before").rlike("[\"']$")),
        "header": flag(F.col("found").startswith("-----BEGIN")),
    })


def _draw(seed: str, alphabet: str, n: int) -> str:
    out, k = "", 0
    while len(out) < n:
        out += "".join(alphabet[b % len(alphabet)] for b in hashlib.sha256(f"{seed}{k}".encode()).digest())
        k += 1
    return out[:n]


def LABELLED(rounds: int = 40) -> list[tuple[str, int]]:
    """Labelled findings, each a line with one candidate: 1 a secret, 0 none. The same on every call."""
    upper, lower, digit, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    mixed = upper + lower + digit
    near = ["the", "of and", "sur le", "und der", "que el", "is here", "with", "note"]
    rows: list[tuple[str, int]] = []
    for k in range(rounds):
        d = lambda name, alphabet, n: _draw(f"{k}{name}", alphabet, n)  # noqa: B023, E731
        w = near[k % len(near)]
        tail = ["", " and", ".", " then"][k % 4]
        eq = ["=", ": ", " = ", ":"][k % 4]
        q = ["", '"', "'"][k % 3]
        has = lambda s: s if any(c.isdigit() for c in s) else s[:-1] + "7"
        bare = lambda name, n: d(name, upper, n) if k % 3 == 0 else has(d(name, upper + "234567", n))  # noqa: B023, E731
        body = "\n".join(d(f"pem{n}", mixed + "+/", 64) for n in range(2 + k % 12)) + "\n" + d("pemx", mixed, 3 + k % 20) + "="
        block = ["-----BEGIN RSA PRIVATE KEY-----", f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----", f"-----BEGIN EC PRIVATE KEY-----\n{body}"][k % 3]
        yes = [
            f"AKIA{bare('aws', 16)}", f"aws ASIA{bare('sts', 16)}", f"ghp_{d('gh', upper + lower, 36) if k % 4 == 0 else has(d('gh', mixed, 36))}", f"xoxb-{d('s1', digit, 11)}-{has(d('s2', mixed, 24))}", f"sk_live_{has(d('st', mixed, 24))}", f"AIza{has(d('g', mixed + '-_', 35))}", f"glpat-{has(d('gl', mixed, 20))}",
            f"password={d('p', hexa, 10 + k % 14)}", f"password{eq}{q}{has(d('p2', mixed + '!$%&*', 9 + k % 12))}{q}", f"passwd{eq}{has(d('p3', lower + digit, 8 + k % 10))}", f"pwd={has(d('p4', mixed, 8 + k % 8))}",
            f"token{eq}{q}{d('t', hexa, 32 + 8 * (k % 2))}{q}", f'token = "{d("t2", hexa, 40)}"', f"api_key{eq}{q}{has(d('a', mixed, 32))}{q}", f"secret{eq}{has(d('sec', mixed + '+/', 40))}", f"client_secret{eq}{q}{has(d('c', mixed + '_-', 24 + k % 20))}{q}",
            f"bearer eyJ{has(base64.urlsafe_b64encode(d('j', mixed, 30).encode()).decode().rstrip('='))}", f"access_key={has(d('ak', mixed, 20))}", block, f"authorization key {has(d('au', mixed, 40))}",
        ]
        no = [
            d("n1", digit, 12 + k % 8), f"card {d('n2', digit, 16)}", f"call +{d('n3', digit, 12)}", f"isbn 978-{d('n4', digit, 1)}-{d('n5', digit, 4)}-{d('n6', digit, 4)}-{d('n7', digit, 1)}", "-".join(d(f"u{n}", hexa, n) for n in (8, 4)) + "-" + "-".join(d(f"u{n}", hexa, 4) for n in (5, 6)) + "-" + d("u9", hexa, 12),
            f"commit {has(d('h1', hexa, 40))}", f"sha256 {has(d('h2', hexa, 64))}", f"md5 checksum {has(d('h3', hexa, 32))}", f"etag {has(d('h4', hexa, 32))}", f"integrity sha384-{has(d('h5', mixed + '+/', 64))}", f"2024{d('d1', '01', 2)}1{d('d2', digit, 1)}T12{d('d3', '012345', 2)}00Z",
            f"IMG_2021{d('f1', digit, 4)}_{d('f2', digit, 6)}.jpg", f"report-final-draft-{d('f3', digit, 4)}.pdf", f"http://site.example/{w.split()[0]}/{d('l', digit, 5)}-article-title/page", f"chapter-{1 + k % 30}-section-{d('s', digit, 2)}", f"userName{d('v', digit, 2)}ForIndexPage", f"release-version-{d('v1', digit, 1)}-{d('v2', digit, 2)}",
            ["password=changeme123", "password: incorrect", "password=your_password", "password: required"][k % 4], ["token=placeholder", "token: invalid-token", "token=your-token-here", "token=example_token_1"][k % 4], ["api_key=xxxxxxxxxxxxxxxx", "api_key=YOUR_API_KEY", "api_key=example", "api_key: missing"][k % 4], ["secret=changeme", "secret: todo-value", "secret=your_secret_here"][k % 3],
            f"AKIA{'EXAMPLE' * 2}{d('x', '01', 2)}", f"order no {d('o', upper, 3)}-{d('o2', digit, 9)}", f"serial {d('z', upper + digit, 4)}-{d('z2', digit, 4)}-{d('z3', digit, 4)}", f"{d('r', lower, 9)}-{d('r2', lower, 8)}-{d('r3', digit, 2)}", f"test-data-file-{d('y', digit, 6)}", f"doi 10/{d('doi', digit, 8)}/{d('doi2', digit, 5)}",
        ]
        rows += [(f"{w} {x}{tail}", 1) for x in yes] + [(f"{w} {x}{tail}", 0) for x in no]
    return rows


def train(spark: SparkSession) -> RandomForestClassificationModel:
    """The forest, from the labelled findings: a table of a fixed size."""
    rows = json.dumps([{"doc_id": k, "text": t, "label": y} for k, (t, y) in enumerate(LABELLED())])
    labelled = spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<doc_id: long, text: string, label: double>>")))
    found = features(candidates(labelled)).join(labelled.select("doc_id", "label"), "doc_id")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="x", labelCol="label").fit(_vector(found.coalesce(1).sortWithinPartitions("doc_id", "n")))


def _vector(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="x").transform(found)


def judged(docs: DataFrame, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """Candidates with ``value``, ``score`` and ``is_secret``."""
    model = model or train(docs.sparkSession)
    scored = model.transform(_vector(features(candidates(docs))))
    score = vector_to_array(F.col("probability")).getItem(1)
    return scored.select("doc_id", "key", "n", "start", "found", "value", "assigned", "header", "prefix", score.alias("score")).withColumn("is_secret", F.col("score") >= THRESHOLD)


def scan(docs: DataFrame) -> DataFrame:
    """A row per candidate of every row of ``doc_id, text``.

    ``n`` (from 1), ``start`` and ``length`` in code points, ``kind``, digest of
    the value, the forest's ``score`` and ``is_secret``. Values themselves are
    not given out. A score of one half is a secret. Null and empty texts have no
    rows; repeated rows give theirs each; other columns are ignored.
    """
    kind = F.when(F.col("header") == 1, "private_key").when(F.col("assigned") == 1, "assignment").when(F.col("prefix") == 1, "known_prefix").otherwise("run")
    start = (F.col("start") + F.length("found") - F.length("value")).cast("long")
    return judged(docs).select("doc_id", "n", start.alias("start"), F.length("value").cast("long").alias("length"), kind.alias("kind"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")


def redact(docs: DataFrame) -> DataFrame:
    """``docs``, all rows and columns, with each secret's value in ``text`` replaced by ``MASK``.

    Only the places that were judged change: the same characters elsewhere
    stay. A column ``n_chars`` follows the new text. Null texts stay null.
    """
    columns = docs.columns
    key, salt, spans = (free(columns, c) for c in ("key", "salt", "spans"))
    found = judged(docs.select(F.lit(0).alias("doc_id"), "text")).filter("is_secret").select("key", "n", F.length("value").alias("length")).distinct()
    found = cut(found.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("n", "length"))).alias(spans)).withColumnRenamed("key", key))
    small = (found.agg(F.sum(F.size(spans))).first()[0] or 0) <= BROADCAST_SECRETS
    out = docs.withColumn(key, F.xxhash64("text"))
    if small:
        out = out.join(F.broadcast(found), key, "left")
    else:
        # A third of all rows may have one text, or none: their key has several parts.
        out = out.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        out = out.join(found.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [key, salt], "left")

    def put(found: Column, gaps: Column) -> Column:
        def one(gap: Column, i: Column) -> Column:
            m, n = F.get(found, i), F.try_element_at(F.col(spans), i + 1)
            return F.concat(gap, F.coalesce(F.when(n.isNull(), m).otherwise(F.concat(F.left(m, F.length(m) - n), F.lit(MASK))), F.lit("")))

        return F.array_join(F.transform(gaps, one), "")

    text = F.when(F.col(spans).isNull() | F.col("text").isNull(), F.col("text")).otherwise(put(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)), F.split("text", CANDIDATE, -1)))
    out = out.withColumn("text", text).select(*[F.col(f"`{c}`") for c in columns])
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
