r"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Mentions are found by pattern: addresses (an empty label in a domain does not matter), phone numbers, card numbers (only with a right check digit),
IPv4 addresses, social security numbers, IBANs (likewise), and names behind a form of address or a
well-known given name. A mention has one part, a name one per word; equal parts, whatever their
spacing or case, are one entity. An entity's surrogate comes from a hash of key, type and value:
digits become digits, letters letters of the script, check digits are right again, names keep the
ending that tells the gender. It is put into each mention's own spacing and case.

Collisions are checked over the corpus: no two entities of a type share a surrogate, and none equals
a value that occurs. Who comes second tries again with the next hash, names with longer ones in time.
After ROUNDS tries, when a format is all but used up, the type and 24 hash digits stand in.

Limits: given names are a fixed list, names behind other words are not found, titles without gender
(Dr, Prof) neither; a national phone number needs the form ddd-ddd-dddd or (ddd) ddd-dddd.

Results by case: null texts stay null, texts without a mention stay as they are, empty ones too. Rows
keep all columns of any name, repeated rows are replaced alike. Long texts are read whole. An empty
table gives no rows. Only the text is read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import staged

ROUNDS = 24

# Forms of address and common given names, by gender.
ADDRESS = {
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra г-жа госпожа κυρία".split(),
    "m": "Mr Herr Monsieur Señor Sr г-н господин κύριος".split()}
GIVEN = {
    "f": ("Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Anna Maria Laura Emma Sophie "
          "Claire Camille Julia Katharina Ursula Sabine Carmen Lucía Elena Анна Мария Елена Ольга Наталья "
          "Татьяна Ирина Светлана Μαρία Ελένη Κατερίνα Βασιλική").split(),
    "m": ("James John Robert Michael William David Richard Joseph Thomas Charles Daniel Peter Paul Hans "
          "Klaus Wolfgang Jürgen Pierre Jacques François Carlos José Miguel Иван Александр Дмитрий Сергей "
          "Андрей Алексей Михаил Владимир Γιώργος Δημήτρης Νίκος Κώστας").split()}
#: What surrogate names are made of, by script: first sounds, vowels, endings.
SOUNDS = {
    "latin": ("b d f g k l m n p r s t v z br dr gr st tr kl".split(), "a e i o u".split()),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у я".split()),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε η ι ο υ ω".split())}
ENDINGS = {
    "latin": {"given_f": "a ina elle ia", "given_m": "o an rik us", "given_u": "y is en ley",
              "surname_f": "man sen ford well", "surname_m": "man sen ford well", "surname_u": "man sen ford well"},
    "cyrillic": {"given_f": "а ина ия ея", "given_m": "ан ей ор ил", "given_u": "ша ня",
                 "surname_f": "ова ина ская", "surname_m": "ов ин ский", "surname_u": "ко ых"},
    "greek": {"given_f": "α ία η ίνα", "given_m": "ος ης ας", "given_u": "ι ω",
              "surname_f": "ου ίδου άκη", "surname_m": "όπουλος ίδης άκης", "surname_u": "άκη ίδη"}}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщэюя",
           "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

#: Characters of an IBAN after country and check digits, by country; others are found by their groups.
ACCOUNT = {
    11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK",
    17: "CH HR LI LV", 18: "BG BH CR DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL",
    20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "LY PT ST", 22: "IS TR", 23: "BI DJ FR GR IT MC MR SM",
    24: "AL AZ BY CY DO GT HN HU LB NI PL SV", 25: "BR EG PS QA UA", 26: "JO KW MU YE", 27: "MT SC", 28: "LC",
    29: "RU"}
_IBAN = "|".join(
    rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4}}}" + rf" ?[A-Z0-9]{{{n % 4}}}" * (n % 4 > 0)
    for n, countries in ACCOUNT.items())
_START, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_FORMS = "|".join(x for f in ADDRESS["f"] + ADDRESS["m"] for x in dict.fromkeys((f, f[0].upper() + f[1:])))
_WORD = rf"(?!(?:{_FORMS})\b)\p{{Lu}}[\p{{L}}'’-]+"
_KNOWN = "|".join(GIVEN["f"] + GIVEN["m"])
PATTERNS = {
    # labels are not told apart here: a loop around them would recurse once a label
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?=[\p{L}\p{N}-])[\p{L}\p{N}.-]+\.\p{L}{2,}",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.[0-9])",
    "card": rf"{_START}(?:[0-9]{{13,19}}|[0-9]{{4}}([ -])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{1,7}}"
            rf"|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}){_END}",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "iban": rf"{_START}(?:(?:{_IBAN})|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?){_END}",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
             r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
             rf"|\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}|[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}){_END}",
    "name": rf"{_START}(?:(?:{_FORMS})\.? {_WORD}(?: {_WORD}){{0,2}}|(?:{_KNOWN})(?: {_WORD}){{1,2}}){_END}"}
#: One alternative for each, begun only where its first character can stand.
ANY = (rf"{PATTERNS['email']}|(?=[0-9])(?:{PATTERNS['ip']}|{PATTERNS['card']}|{PATTERNS['ssn']})"
       rf"|(?=[+(0-9]){PATTERNS['phone']}|(?=[A-Z]{{2}}[0-9]){PATTERNS['iban']}"
       rf"|{_START}(?=\p{{L}})(?:{PATTERNS['name']})")


def _mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _check_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and its own digits added."""
    def one(c, i):
        d = c.cast("int")
        double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, double).otherwise(d)

    return _total(F.transform(F.reverse(_chars(digits)), one))


def _mod97(value: Column) -> Column:
    """Remainder of an IBAN, its first four characters last and letters as numbers from 10 on."""
    turned = F.concat(F.substring(value, 5, 64), F.substring(value, 1, 4))
    return F.aggregate(_chars(turned), F.lit(0), lambda r, c: F.when(
        c.rlike("[0-9]"), (r * 10 + (F.ascii(c) - 48)) % 97).otherwise((r * 100 + (F.ascii(c) - 55)) % 97))


def _script(part: Column) -> Column:
    return (F.when(part.rlike(r"\p{IsCyrillic}"), "cyrillic").when(part.rlike(r"\p{IsGreek}"), "greek")
            .otherwise("latin"))


def _among(part: Column, names: list[str]) -> Column:
    return F.lower(F.regexp_replace(part, r"\.$", "")).isin([n.lower() for n in names])


def _name_parts(mention: Column) -> Column:
    """(part, type, value) of each word of a name; a form of address has no type."""
    words = F.split(mention, " ")
    first, n = words[0], F.size(words)
    form = _among(first, ADDRESS["f"] + ADDRESS["m"])
    of_form = F.when(_among(first, ADDRESS["f"]), "f").when(_among(first, ADDRESS["m"]), "m")
    of_given = lambda w: F.when(_among(w, GIVEN["f"]), "f").when(_among(w, GIVEN["m"]), "m")
    gender = F.coalesce(of_form, of_given(first), F.lit("u"))

    def part(word, i):
        role = F.when(i == n - 1, "surname").otherwise("given")
        cyrillic = F.when(word.rlike(r"\p{IsCyrillic}"), F.when(word.rlike("(?iu)(а|ая)$"), "f").otherwise("m"))
        # surnames are one entity for all genders, but where the script writes them differently
        own = F.when(role == "surname", F.coalesce(cyrillic, F.when(
            word.rlike(r"\p{IsGreek}"), gender), F.lit("u"))).otherwise(F.coalesce(of_given(word), gender))
        kind = F.concat(role, F.lit("_"), own, F.lit(":"), _script(word))
        return F.struct(word.alias("part"), F.when((i == 0) & form, F.lit(None)).otherwise(kind).alias("type"),
                        F.lower(word).alias("value"))

    return F.transform(words, part)


def _iban_parts(mention: Column) -> Column:
    """The longest run of words from the first that has right check digits, and what follows it."""
    words = F.split(mention, " ")
    run = lambda n: F.array_join(F.slice(words, F.lit(1), n), "")
    right = F.filter(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: _mod97(run(n)) == 1)
    n = F.get(right, F.lit(0))
    part = lambda text, kind, value: F.struct(
        text.alias("part"), kind.alias("type"), value.alias("value"))
    none = F.lit(None).cast("string")
    rest = F.array_join(F.slice(words, n + 1, F.size(words)), " ")
    iban = part(F.array_join(F.slice(words, F.lit(1), n), " "), F.lit("iban"), run(n))
    return (F.when(n.isNull(), F.array(part(mention, none, F.regexp_replace(mention, " ", ""))))
            .when(n < F.size(words), F.array(iban, part(rest, none, rest))).otherwise(F.array(iban)))


def _parts(mention: Column) -> Column:
    """The parts of a mention; what only looks like personal data has no type."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    whole = lambda kind, value: F.array(F.struct(
        mention.alias("part"), kind.alias("type"), value.alias("value")))
    is_kind = lambda kind: mention.rlike(f"^(?:{PATTERNS[kind]})$")
    phone = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return (F.when(mention.contains("@"), whole(F.lit("email"), F.lower(mention)))
            .when(is_kind("ip"), whole(F.lit("ip"), mention))
            .when(is_kind("card"), whole(F.when(_check_sum(digits) % 10 == 0, "card"), digits))
            .when(is_kind("ssn"), whole(F.lit("ssn"), digits))
            .when(mention.rlike(r"^[+(0-9]"), whole(F.lit("phone"), phone))
            .when(is_kind("iban"), _iban_parts(mention))
            .otherwise(_name_parts(mention)))


def _number(place: Column, below: int) -> Column:
    """A number from the digest, by place."""
    at = (place % 60) * 2 + 1
    return F.conv(F.substring(F.col("digest"), at, 4), 16, 10).cast("int") % below


def _letter(script: str, place: Column) -> Column:
    letters = LETTERS[script]
    return F.substring(F.lit(letters), _number(place, len(letters)) + 1, F.lit(1))


def _same_kind(value: Column, first_stays: int = 0) -> Column:
    """Each digit another digit, each letter another of its script; a first digit is not 0."""
    def one(c, i):
        digit = F.when(i == 0, 1 + _number(i, 9)).otherwise(_number(i, 10)).cast("string")
        letter = (F.when(c.rlike(r"\p{IsCyrillic}"), _letter("cyrillic", i))
                  .when(c.rlike(r"\p{IsGreek}"), _letter("greek", i)).otherwise(_letter("latin", i)))
        other = F.when(c.rlike("[0-9]"), digit).when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(
            c.rlike(r"\p{L}"), letter).otherwise(c)
        return F.when(i < first_stays, c).otherwise(other)

    return F.array_join(F.transform(_chars(value), one), "")


def _octets(value: Column) -> Column:
    """As many digits in each octet; private networks stay private."""
    octets = F.split(value, r"\.")
    private = value.rlike(r"^(10|127|192\.168|172\.(1[6-9]|2[0-9]|3[01]))\.")

    def one(o, i):
        n = _number(i * 4, 1 << 16)
        other = (F.when(F.length(o) == 1, 1 + n % 9).when(F.length(o) == 2, 11 + n % 89)
                 .otherwise(128 + n % 64))
        return F.when(private & (i < 2), o).otherwise(other.cast("string"))

    return F.array_join(F.transform(octets, one), ".")


def _name(script: str, kind: str) -> Column:
    sounds, vowels = SOUNDS[script]
    endings = ENDINGS[script][kind].split()
    pick = lambda words, place: F.element_at(F.array(*map(F.lit, words)), _number(place, len(words)) + 1)
    syllables = F.lit(2 if kind.startswith("given") else 3) + F.floor(F.col("attempt") / 4).cast("int")
    made = F.transform(F.sequence(F.lit(1), syllables), lambda j: F.concat(
        pick(sounds, j * 4), pick(vowels, j * 4 + 2)))
    return F.concat(F.array_join(made, ""), pick(endings, F.lit(0)))


def _surrogate() -> Column:
    """Surrogate of an entity (type, value, attempt, digest)."""
    kind, value = F.col("type"), F.col("value")
    end = F.substring_index(value, ".", -1)
    head = F.expr("left(value, length(value) - length(substring_index(value, '.', -1)))")
    body = _same_kind(F.expr("left(value, length(value) - 1)"), first_stays=1)
    check = (10 - _check_sum(F.concat(body, F.lit("0"))) % 10) % 10
    account = _same_kind(F.substring(value, 5, 64))
    country = F.substring(value, 1, 2)
    checks = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    out = (F.when(kind == "email", F.concat(_same_kind(head), end)).when(kind == "ip", _octets(value))
           .when(kind == "card", F.concat(body, check.cast("string")))
           .when(kind == "iban", F.concat(country, checks, account)))
    for script, endings in ENDINGS.items():
        for name in endings:
            out = out.when(kind == f"{name}:{script}", _name(script, name))
    return out.otherwise(_same_kind(value))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """type, value, surrogate of each entity (type, value; each once), all distinct by type."""
    values = entities.select("type", F.col("value").alias("surrogate"))
    waiting, done, attempt = entities.select("type", "value"), None, 0
    while attempt < ROUNDS:
        digest = F.sha2(F.concat_ws("|", F.lit(key), "type", F.lit(str(attempt)), "value"), 512)
        tried = staged(waiting.withColumn("attempt", F.lit(attempt)).withColumn("digest", digest)
                       .select("type", "value", _surrogate().alias("surrogate")), "tried")
        free = tried.join(values, ["type", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        settled = staged(free.groupBy("type", "surrogate").agg(F.min("value").alias("value"))
                         .select("type", "value", "surrogate"), "settled")
        done = settled if done is None else done.union(settled)
        waiting = staged(tried.join(settled, ["type", "value"], "left_anti").select("type", "value"), "waiting")
        if waiting.isEmpty():
            return done
        attempt += 1
    stand_in = F.concat(F.col("type"), F.lit("-"), F.substring(
        F.sha2(F.concat_ws("|", F.lit(key), "type", "value"), 256), 1, 24))
    return done.union(waiting.select("type", "value", stand_in.alias("surrogate")))


def _put(part: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the spacing and case of a mention's part; what leads a number stays.

    An address is its own format and may have any length; all else that is filled character by character
    is bounded by its pattern.
    """
    room = F.length(F.regexp_replace(part, r"[^\p{L}\p{N}]", ""))
    fill = F.regexp_replace(surrogate, r"[^\p{L}\p{N}]", "")
    more = room - F.length(fill)  # country code that the value is without

    def one(c, i):
        at = F.length(F.regexp_replace(F.substring(part, F.lit(1), i + 1), r"[^\p{L}\p{N}]", "")) - more
        return F.when(c.rlike(r"[\p{L}\p{N}]") & (at > 0), F.substring(fill, at, F.lit(1))).otherwise(c)

    filled = F.array_join(F.transform(_chars(part), one), "")
    cased = F.when(part.rlike(r"\p{L}") & (part == F.upper(part)), F.upper(filled)).otherwise(filled)
    name = F.when((part == F.upper(part)) & (F.length(part) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    address = F.when(part == F.upper(part), F.upper(surrogate)).otherwise(surrogate)
    return (F.when(kind.rlike("^(given|surname)_"), name).when(kind == "email", address)
            .when(more < 0, surrogate).otherwise(cased))


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with personal data replaced in ``text``; who has ``key`` can link surrogates to values.

    Only texts with a mention are joined, by a hash of what they mention; each text is then put
    together from what stands between its mentions and their replacements.
    """
    some = F.coalesce(F.col(text).rlike(ANY), F.lit(False))
    listed = docs.where(some).select(_mentions(F.col(text)).alias("mentions"))
    lists = staged(listed.groupBy("mentions").count().select(
        _list_key(F.col("mentions")).alias("list"), "mentions"), "pii-lists")
    each = lists.select("list", F.posexplode("mentions").alias("at", "mention"))
    mentions = staged(each.select("mention").distinct().select(
        "mention", F.posexplode(_parts(F.col("mention"))).alias("place", "p")).select(
            "mention", "place", "p.part", "p.type", "p.value"), "pii-mentions")
    entities = staged(mentions.where("type IS NOT NULL").select("type", "value").distinct(), "pii-entities")
    found = staged(surrogates(entities, key), "pii-surrogates")
    put = mentions.join(found, ["type", "value"], "left").select("mention", "place", F.coalesce(
        _put(F.col("part"), F.col("type"), F.col("surrogate")), "part").alias("put"))
    new = staged(put.groupBy("mention").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("place", "put"))), lambda p: p["put"]), " ").alias("new")), "pii-replaced")
    new_lists = staged(each.join(new, "mention").groupBy("list").agg(F.transform(F.sort_array(
        F.collect_list(F.struct("at", "new"))), lambda p: p["new"]).alias("new")), "pii-new-lists")

    names = docs.columns
    rows = docs.where(some).select(F.struct("*").alias("row"), F.col(text).alias("old"))
    joined = rows.withColumn("list", _list_key(_mentions(F.col("old")))).join(new_lists, "list")
    whole = F.array_join(F.zip_with(F.split("old", ANY, -1), "new", lambda gap, n: F.concat(
        gap, F.coalesce(n, F.lit("")))), "")
    changed = joined.select(*[
        whole.alias(c) if c == text else F.col("row")[c].alias(c) for c in names])
    return docs.where(~some).union(changed)


def _list_key(mentions: Column) -> Column:
    return F.sha2(F.to_json(mentions), 256)
