"""PII surrogates, in DataFrame operations only.

Detected entities (e-mail addresses, IBANs, IPv4 addresses, card, social
security and phone numbers, titled personal names) get keyed replacements of
their own type and format.  The replacement depends on the key, the type and
the normalised entity alone, so all mentions of an entity, however written,
get the same one (coreference).

Numbers, addresses and mailboxes: a keyed permutation of all strings of the entity's format
(a Feistel network over its characters, each rotated within digits, small or capital
letters, or octets; conjugated with a fixed rotation, so nothing maps to itself).
Being a permutation it never gives two entities one replacement.  Replacements that are entities of the
corpus themselves are looked up by a join, and only these are permuted again under the next
round's key.  Where a format holds a quarter of all its strings or more, and after
``ROUNDS`` rounds, all entities of that format take the first round's replacement: distinct, never
their own, but possibly another entity's.  So the rounds end, however full a format is.
Names are made of syllables and checked until no two share one and none occurs; every
round's names are longer, so that ends too.

Kept of each entity: a number's punctuation, length and letter case, an e-mail's top
domain, a phone's country code, an IBAN's country and spacing and whether its check digits hold, a card's first digit and whether its check digit holds, a name's title, particles,
hyphens and apostrophes, letter case, gender (from the title; Slavic family names by their ending) and script;
of an initial's replacement the first letter is written.  An e-mail without a letter or
digit that could change gets letters before it.

Shuffled are the mentions, the entity table and the documents that have
entities; all others pass by.

Defined results: a null text stays null and '' stays ''; repeated rows are
replaced alike; other columns pass through, one named like the count is
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize, with_columns_once
from newsfunnel.llm.common import free_name, without

# Titles by gender, as written before names.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "г-жа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "г-н"),
    "n": ("Dr", "Prof"),
}
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True)) + r")\.?"
# Words inside names that are no names themselves, and what follows a name.
_PARTICLE = "(?:von|van|vom|zu|zur|zum|der|den|de|del|della|di|da|das|do|dos|du|des|la|le|las|los|ter|ten|af|av|bin|ibn|al|el|y)"
_AFTER = r"(?:Jr|Sr|II|III|IV)(?![\p{L}\p{N}])"
_INITIALS = r"(?:\p{Lu}\.-?)++"
#: a name, initials, or one letter before a name; not the next person's title
_NAME = rf"(?!{_TITLE} |{_AFTER})(?:\p{{Lu}}[\p{{L}}’'-]++|{_INITIALS}|\p{{Lu}}(?= \p{{Lu}}[\p{{L}}’'. -]))"
_NAMES = rf"(?:{_PARTICLE} )*+{_NAME}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: type -> pattern; of several that match at a place the first counts
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}| [A-Z0-9]{4}(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)",
    "card": r"(?<![\w.-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?![\w])",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_TITLE} {_NAMES}(?: {_NAMES})*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
ROUNDS = 40  # rounds of a format's permutations before the first one stands; half of what is left passes each
CROWDED = 4  # a format is crowded when 1 of CROWDED of its strings occur

# Syllables that replacement names are made of, by script; endings by gender.
_SYLLABLES = {
    "latin": (("Al", "Be", "Ca", "Da", "El", "Fa", "Ga", "Ha", "Is", "Jo", "Ka", "Lo", "Ma", "No", "Ro", "Ta"),
              ("ba", "de", "fi", "ga", "ke", "li", "mo", "na", "pe", "ra", "se", "ti", "va", "ri", "lo", "du"),
              {"f": ("na", "lia", "ra", "ssa", "tta", "nia", "lla", "da"), "m": ("nus", "rton", "n", "ric", "ldo", "mar", "s", "bert"),
               "n": ("re", "lin", "ne", "ley", "ton", "by", "well", "field")}),
    "cyrillic": (("Ал", "Бо", "Ва", "Га", "Да", "Ел", "За", "Ив", "Ка", "Ла", "Ма", "Ни", "Ол", "Па", "Ро", "Та"),
                 ("ба", "ве", "ги", "до", "же", "зи", "ка", "ле", "ми", "но", "па", "ре", "си", "ту", "фе", "ши"),
                 {"f": ("на", "лия", "ра", "са", "та", "ния", "ла", "да"), "m": ("н", "слав", "мир", "рий", "ль", "р", "с", "дан"),
                  "n": ("ко", "ук", "ич", "ец", "як", "ман", "сон", "ер"), "ov": ("ов", "ев", "ин", "нов", "ков", "лев", "рин", "тин")}),
}
#: family names with a feminine form in -а
_INFLECTED = "(?:ов|ев|ёв|ин|ын)"


def _draw(hexes: Column, at: int, n: int) -> Column:
    """A number below n from eight hex digits of the keyed digest."""
    return (F.conv(F.substring(hexes, 8 * at + 1, 8), 16, 10).cast("long") % n).cast("int")


def _pick(hexes: Column, at: int, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _draw(hexes, at, len(values)) + 1)


_OCTETS = "".join(chr(0x4E00 + n) for n in range(256))
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _OCTETS)
_CHARS = "(?!^)(?!$)"


def _rotated(text: Column, hexes: Column, sign: int = 1, moves: bool = False) -> Column:
    """Every character of ``_ALPHABETS`` rotated within its alphabet by two hex digits of ``hexes`` (with ``moves`` by
    one place at least); others stay.  A bijection for given ``hexes``."""
    def one(c: Column, i: Column) -> Column:
        v = F.conv(F.substr(hexes, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = F.when(F.lit(False), c)
        for letters in _ALPHABETS:
            n, at = len(letters), F.instr(F.lit(letters), c)
            step = v % (n - 1) + 1 if moves else v % n
            out = out.when((at > 0) & (c != ""), F.substr(F.lit(letters), F.pmod(at - 1 + sign * step, F.lit(n)) + 1, F.lit(1)))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, _CHARS), one), "")


_PASSES = 4


def permuted(df: DataFrame, col: str, out: str, key: str, kind: str, draw: str) -> DataFrame:
    """Add ``out``: the string of ``col`` under a keyed permutation of all strings of its format that
    maps no string with a letter or digit to itself.  The key: (``key``, columns ``kind`` and ``draw``)."""
    def stream(*what: Column) -> Column:
        return F.sha2(F.concat_ws("\u0001", F.lit(key), F.col(kind), F.col(draw).cast("string"), *what).cast("binary"), 512)

    half = F.floor(F.length(col) / 2).cast("int")
    x = with_columns_once(df, {"_a": F.substr(F.col(col), F.lit(1), half), "_b": F.substr(F.col(col), half + 1)})

    def step(x: DataFrame, n: int, sign: int) -> DataFrame:
        own, other = ("_a", "_b") if n % 2 == 0 else ("_b", "_a")
        return with_columns_once(x, {"_n": _rotated(F.col(own), stream(F.lit(str(n)), F.col(other)), sign)}).drop(own).withColumnRenamed("_n", own)

    for n in range(_PASSES):
        x = step(x, n, 1)
    x = with_columns_once(x, {"_c": _rotated(F.col("_a"), stream(F.lit("a")), 1, True), "_d": _rotated(F.col("_b"), stream(F.lit("b")), 1, True)})
    x = x.drop("_a", "_b").withColumnsRenamed({"_c": "_a", "_d": "_b"})
    for n in reversed(range(_PASSES)):
        x = step(x, n, -1)
    return x.withColumn(out, F.concat("_a", "_b")).drop("_a", "_b")


def _luhn(body: Column) -> Column:
    """Check digit that makes ``body`` followed by it valid, as a number."""
    digits = F.transform(F.reverse(F.split(body, "(?!^)(?!$)")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2).otherwise(c.cast("int")))
    total = F.aggregate(digits, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return (F.lit(10) - total % 10) % 10


def _iban_check(country: Column, account: Column) -> Column:
    """Check digits of an IBAN, as a number: 98 less the rest of its digits (letters as 10 to 35) by 97."""
    letters = F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def add(a: Column, c: Column) -> Column:
        v = F.instr(letters, c) - 1
        return F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97

    return F.lit(98) - F.aggregate(F.split(F.concat(account, country, F.lit("00")), _CHARS), F.lit(0), add)


def segments(m: Column) -> Column:
    """A mention as array of (before, type, piece): text that stays, and what is replaced."""
    def one(before: Column, kind, piece: Column) -> Column:
        return F.struct(before.alias("before"), (F.lit(kind) if isinstance(kind, str) else kind).alias("type"), piece.alias("piece"))

    country = F.regexp_extract(m, r"^(\+\d{1,3}(?=[ .(-]))", 1)
    title = F.regexp_extract(m, f"^{_TITLE} ", 0)
    bare = F.regexp_replace(title, r"[. ]", "")
    gender = reduce(lambda w, g: w.when(bare.isin(*TITLES[g]), F.lit(g)), ("f", "m"), F.when(F.lit(False), F.lit("n"))).otherwise(F.lit("n"))
    rest = F.substr(m, F.length(title) + 1)
    pattern = F.lit(f"((?:{_PARTICLE} )*+)({_NAME})")
    kept, words = F.regexp_extract_all(rest, pattern, F.lit(1)), F.regexp_extract_all(rest, pattern, F.lit(2))
    script = F.when(F.element_at(words, 1).rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    # the last word is the family's, those before it are given names
    name = F.transform(words, lambda w, i: one(
        F.concat(F.when(i == 0, title).otherwise(F.lit(" ")), F.get(kept, i)),
        F.when(i == F.size(words) - 1, F.concat(F.lit("family_"), script, F.when(F.lower(w).rlike(rf"\p{{L}}{_INFLECTED}а?$") & (script == "cyrillic"), "_ov").otherwise(""))).otherwise(F.concat(F.lit("given_"), script, F.lit("_"), gender)), w))
    out = F.when(m.rlike(f"^(?:{PATTERNS['name']})$"), name)
    for kind in ("email", "iban", "ip", "card", "ssn"):
        out = out.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), F.array(one(F.lit(""), kind, m)))
    return out.otherwise(F.array(one(country, "phone", F.substr(m, F.length(country) + 1))))


def core(kind: Column, piece: Column) -> Column:
    """The entity behind a written form."""
    return (F.when(kind.isin("card", "ssn", "phone"), F.regexp_replace(piece, "[^0-9]", ""))
            .when(kind == "ip", piece).when(kind == "iban", F.replace(piece, F.lit(" "), F.lit("")))
            .when(kind == "family_cyrillic_ov", F.regexp_replace(F.lower(piece), "а$", "")).otherwise(F.lower(piece)))


def _octet_chars(ip: Column) -> Column:
    return F.array_join(F.transform(F.split(ip, r"\."), lambda o: F.substr(F.lit(_OCTETS), o.cast("int") + 1, F.lit(1))), "")


def _octets(chars: Column) -> Column:
    return F.array_join(F.transform(F.split(chars, _CHARS), lambda c: (F.instr(F.lit(_OCTETS), c) - 1).cast("string")), ".")


def _spelled(entities: DataFrame) -> DataFrame:
    """Add ``x``, what is permuted of an entity, ``host`` (of an e-mail), and ``shape``, its format."""
    kind, c = F.col("type"), F.col("core")
    n = F.length(c)
    host = F.substring_index(c, "@", -1)
    top = F.substring_index(c, ".", -1)
    x = (F.when(kind == "email", F.substring_index(c, "@", 1)).when(kind == "ip", _octet_chars(c)).when(kind == "card", F.substr(c, F.lit(2), n - 2))
         .when(kind == "iban", F.substr(c, F.lit(5))).otherwise(c))
    card = F.pmod(F.substr(c, n).cast("int") - _luhn(F.substr(c, F.lit(1), n - 1)), F.lit(10))
    iban = F.pmod(F.substring(c, 3, 2).cast("int") - _iban_check(F.substring(c, 1, 2), F.substr(c, F.lit(5))), F.lit(100))
    rest = (F.when(kind == "email", top).when(kind == "card", F.concat_ws(":", F.substring(c, 1, 1), card.cast("string")))
            .when(kind == "iban", F.concat_ws(":", F.substring(c, 1, 2), iban.cast("string"))).otherwise(F.lit("")))
    found = with_columns_once(entities, {"x": x, "host": F.when(kind == "email", F.substr(host, F.lit(1), F.length(host) - F.length(top) - 1)).otherwise(F.lit("")),
                                         "rest": rest})
    free = F.concat("x", "host")
    for letters, mark in zip(_ALPHABETS, "0aA\u4E00"):
        free = F.regexp_replace(free, f"[{letters}]", mark)
    return with_columns_once(found, {"shape": F.concat_ws("\u0001", F.length("x").cast("string"), free, "rest")})


def _made(spelled: DataFrame, key: str) -> DataFrame:
    """Add ``made``: the replacement in draw ``draw``."""
    both = permuted(spelled, "x", "new_x", key, "type", "draw")
    both = permuted(both.withColumns({"_host": F.lit("host"), "_first": F.lit(0)}), "host", "new_host", key, "_host", "_first").drop("_host", "_first")
    kind, x, c = F.col("type"), F.col("new_x"), F.col("core")
    mark, check = F.substring_index("rest", ":", 1), F.substring_index("rest", ":", -1)
    mail = F.concat(x, F.lit("@"), F.col("new_host"), F.lit("."), F.substring_index(c, ".", -1))
    same = F.concat(F.lit("x."), c)  # nothing in it can change
    iban = F.concat(mark, F.lpad(((_iban_check(mark, x) + check.cast("int")) % 100).cast("string"), 2, "0"), x)
    card = F.concat(mark, x, ((_luhn(F.concat(mark, x)) + check.cast("int")) % 10).cast("string"))
    out = (F.when((kind == "email") & (mail == c), same).when(kind == "email", mail).when(kind == "ip", _octets(x)).when(kind == "card", card)
           .when(kind == "iban", iban).otherwise(x))
    return both.withColumn("made", out).drop("new_x", "new_host")


def formats(entities: DataFrame, key: str) -> DataFrame:
    """(type, core, made) of entities with a format: distinct, and no entity of the table where the format has room."""
    spelled = materialize(_spelled(entities), "pii-spelled")
    sizes = (spelled.groupBy("type", "shape").agg(F.count("*").alias("held"))
             .withColumn("marks", F.element_at(F.split("shape", "\u0001"), 2)))
    crowded = sizes.where(F.log10(F.col("held") * CROWDED) >= _log_size(F.col("marks"))).select("type", "shape")
    crowded = materialize(crowded, "pii-crowded")
    first = _made(spelled.join(crowded, ["type", "shape"], "left_semi").withColumn("draw", F.lit(0)), key).select("type", "core", "made")
    real = spelled.select("type", F.col("core").alias("made"))
    todo = spelled.join(crowded, ["type", "shape"], "left_anti")
    done = None
    for draw in range(ROUNDS):
        tried = materialize(_made(todo.withColumn("draw", F.lit(draw)), key), "pii-tried")
        taken = real if done is None else real.unionByName(done.select("type", "made"))
        # an address with an octet 0 or 255 names no host
        odd = tried.where((F.col("type") == "ip") & F.col("made").rlike(r"(?<!\d)(?:0|255)(?!\d)")).select("type", "core")
        again = materialize(tried.join(taken, ["type", "made"], "left_semi").select("type", "core").union(odd).distinct(), "pii-again")
        passed = tried if again.isEmpty() else materialize(tried.join(again, ["type", "core"], "left_anti"), "pii-passed")
        done = passed if done is None else done.unionByName(passed)
        if again.isEmpty():
            return first.unionByName(done.select("type", "core", "made"))
        todo = spelled.join(again, ["type", "core"], "left_semi")
    # a format that is not through takes its first round as a whole
    late = materialize(todo.select("type", "shape").distinct(), "pii-late")
    whole = _made(spelled.join(late, ["type", "shape"], "left_semi").withColumn("draw", F.lit(0)), key)
    return first.unionByName(done.join(late, ["type", "shape"], "left_anti").select("type", "core", "made")).unionByName(whole.select("type", "core", "made"))


def _log_size(marks: Column) -> Column:
    """Decimal logarithm of the number of strings of a format."""
    def many(of: str, each: float) -> Column:
        return F.length(F.regexp_replace(marks, f"[^{of}]", "")) * F.lit(each)

    return many("0", 1.0) + many("aA", 1.414973) + many("\u4E00", 2.408240)


def _names(entities: DataFrame, key: str) -> DataFrame:
    """Add ``made``: the name of (type, core) in draw ``draw``; later draws are longer."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), "type", "core", F.col("draw").cast("string")).cast("binary"), 512)
    h = with_columns_once(entities, {"hexes": digest})
    hexes, kind = F.col("hexes"), F.col("type")
    out = F.when(F.lit(False), F.lit(""))
    for script, (first, middle, last) in _SYLLABLES.items():
        more = F.array_join(F.transform(F.sequence(F.lit(0), F.col("draw")), lambda j: F.when(j == 0, "").otherwise(
            F.element_at(F.array(*map(F.lit, middle)), (F.conv(F.substr(hexes, 33 + (j * 2) % 96, F.lit(2)), 16, 10).cast("int") % len(middle)) + 1))), "")
        for gender, ends in last.items():
            names = [f"family_{script}_ov"] if gender == "ov" else [f"given_{script}_{gender}"] + ([f"family_{script}"] if gender == "n" else [])
            made = F.concat(_pick(hexes, 0, first), _pick(hexes, 1, middle), more, _pick(hexes, 2, middle), _pick(hexes, 3, ends))
            out = out.when(kind.isin(*names), F.lower(made))
    return h.select(*entities.columns, out.alias("made"))


def names(entities: DataFrame, key: str) -> DataFrame:
    """(type, core, made) of names, checked for collisions."""
    table = materialize(_names(entities.withColumn("draw", F.lit(0)), key), "pii-table")
    while True:
        same = (table.groupBy("type", "made").agg(F.min("core").alias("keeps"), F.count("*").alias("c")).where("c > 1").drop("c"))
        real = table.select("type", F.col("core").alias("made")).withColumn("real", F.lit(True))
        judged = (table.join(same, ["type", "made"], "left").join(real, ["type", "made"], "left")
                  .withColumn("again", F.coalesce(F.col("core") != F.col("keeps"), F.lit(False)) | F.coalesce("real", F.lit(False))))
        judged = materialize(judged.select("type", "core", "draw", "made", "again"), "pii-judged")
        if judged.where("again").isEmpty():
            return judged.select("type", "core", "made")
        anew = _names(judged.where("again").select("type", "core", (F.col("draw") + 1).alias("draw")), key)
        table = materialize(judged.where("not again").select("type", "core", "draw", "made").unionByName(anew), "pii-table")


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """(type, core, made): one replacement for each entity."""
    table = materialize(entities.select("type", "core"), "pii-entities")
    named = F.col("type").rlike("^(given|family)")
    return names(table.where(named), key).unionByName(formats(table.where(~named), key))


def written(kind: Column, piece: Column, made: Column) -> Column:
    """The replacement in the form of the mention: digits into its digit places, its letter case."""
    chars = F.split(piece, "(?!^)(?!$)")
    places = F.transform(chars, lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(made, F.length(F.regexp_replace(F.substr(piece, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c))
    initials = F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike(r"\p{Lu}"), F.upper(F.substr(made, i % F.length(made) + 1, F.lit(1)))).otherwise(c)), "")
    # hyphens and apostrophes of a name stay at their places, each part with its first letter's case
    parts, seps = F.split(piece, "[-’']"), F.regexp_extract_all(piece, F.lit("([-’'])"), F.lit(1))

    def part(p: Column, i: Column) -> Column:
        at = F.aggregate(F.slice(parts, 1, i), F.lit(1), lambda a, q: a + F.length(q))
        rest = F.when(at <= F.length(made), F.substr(made, at)).otherwise(made)
        text = F.when(i == F.size(parts) - 1, rest).otherwise(F.substr(F.repeat(made, F.lit(9)), at, F.length(p)))
        first = F.substring(p, 1, 1)
        return F.concat(F.when(first != F.lower(first), F.upper(F.substring(text, 1, 1))).otherwise(F.substring(text, 1, 1)), F.substr(text, F.lit(2)),
                        F.coalesce(F.get(seps, i), F.lit("")))

    shown = F.when(F.size(parts) > 1, F.array_join(F.transform(parts, part), "")).otherwise(F.concat(F.upper(F.substring(made, 1, 1)), F.substr(made, F.lit(2))))
    feminine = F.when((kind == "family_cyrillic_ov") & F.lower(piece).rlike("а$"), F.lit("а")).otherwise(F.lit(""))
    named = kind.rlike("^(given|family)")
    loud = (F.upper(piece) == piece) & (F.lower(piece) != piece)
    cased = (F.when(named & piece.rlike(rf"^(?:\p{{Lu}}|{_INITIALS})$"), initials)
             .when(named, F.when(loud, F.upper(F.concat(shown, feminine))).otherwise(F.concat(shown, feminine)))
             .when(loud, F.upper(made)).otherwise(made))
    spaced = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(
        F.substr(made, F.length(F.replace(F.substr(piece, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    return F.when(kind.isin("card", "ssn", "phone"), F.array_join(places, "")).when(kind == "iban", spaced).when(kind == "ip", made).otherwise(cased)


def replace_entities(df: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """Texts with all entities replaced; ``count_col`` counts the mentions."""
    df = without(df, count_col)
    row, found, outs = (free_name(df, n) for n in ("_row", "_found", "_outs"))
    has = F.coalesce(F.col(text_col).rlike(ANY), F.lit(False))
    held = materialize(df.where(has).withColumn(row, F.monotonically_increasing_id())
                       .withColumn(found, F.regexp_extract_all(text_col, F.lit(ANY), 0)), "pii-documents")
    mentions = with_columns_once(held.select(F.col(row).alias("row"), F.posexplode(found).alias("i", "m")), {"segs": segments(F.col("m"))})
    parts = mentions.select("row", "i", F.posexplode("segs").alias("j", "s")).select("row", "i", "j", "s.before", "s.type", "s.piece")
    parts = materialize(parts.withColumn("core", core(F.col("type"), F.col("piece"))), "pii-mentions")
    table = mapping(parts.select("type", "core").distinct(), key)
    done = (parts.join(table, ["type", "core"])
            .select("row", "i", F.struct("j", F.concat("before", written(F.col("type"), F.col("piece"), F.col("made"))).alias("out")).alias("s"))
            .groupBy("row", "i").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["out"]), "").alias("out"))
            .groupBy(F.col("row").alias(row)).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "out"))), lambda s: s["out"]).alias(outs)))
    joined = held.join(done, row)
    gaps = F.split(F.col(text_col), ANY, -1)  # one more than there are mentions
    text = F.array_join(F.zip_with(gaps, outs, lambda g, o: F.concat(g, F.coalesce(o, F.lit("")))), "")
    changed = joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in df.columns), F.size(found).cast("long").alias(count_col))
    same = df.where(~has).select(*df.columns, F.lit(0).cast("long").alias(count_col))
    return same.unionByName(changed)
