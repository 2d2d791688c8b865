"""Personal data and secrets replaced by surrogates: keyed, of the same type and format, one for each entity.

A surrogate is drawn from a keyed hash of the entity's type and canonical form,
so mentions of one entity stay together across documents.  Of a person's name the
given and the family name are an entity each, so short and full forms agree.  A
name is known by what stands before it, or by a frequent given name; lists are
evidence, and what a word after them says may speak against it.  The distinct entities
are checked for clashes: one whose surrogate equals another's, or an original,
draws again until none does.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .frames import named as named_column
from .frames import slices, written

# Forms of address, by the gender they tell.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Signora", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof", "Mx"],
}
# What letters begin with, before a name.
SALUTATIONS = ["Dear", "Hello", "Hi", "Liebe", "Lieber", "Hallo", "Cher", "Chère", "Bonjour", "Querido", "Querida", "Estimado", "Estimada", "Hola", "Уважаемый", "Уважаемая", "Дорогой", "Дорогая", "Αγαπητέ", "Αγαπητή"]
# Frequent given names, by which a full name without a form of address is known.
KNOWN = {
    "m": ["Adam", "Alexander", "Andrew", "Anthony", "Antonio", "Brian", "Carlos", "Charles", "Christopher", "Daniel", "David", "Edward", "François", "George", "Hans", "Henry", "Jack", "Jacques", "James", "Jean", "Johann", "John", "José", "Joseph", "Juan", "Jürgen", "Kevin", "Klaus", "Luis", "Manuel", "Marco", "Mark", "Matthew", "Michael", "Miguel", "Patrick", "Paul", "Pedro", "Peter", "Philippe", "Pierre", "Richard", "Robert", "Stefan", "Stephen", "Thomas", "Timothy", "Walter", "William", "Wolfgang", "Ahmed", "Ali", "Arjun", "Hiroshi", "Ibrahim", "Kenji", "Mohammed", "Omar", "Raj", "Wei", "Александр", "Алексей", "Андрей", "Борис", "Владимир", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей", "Γιώργος", "Γιάννης", "Δημήτρης", "Κώστας", "Νίκος"],
    "f": ["Alice", "Ana", "Angela", "Anna", "Anne", "Barbara", "Carmen", "Catherine", "Charlotte", "Christine", "Claudia", "Deborah", "Elena", "Elisabeth", "Elizabeth", "Emily", "Emma", "Françoise", "Giulia", "Hannah", "Heike", "Isabel", "Jane", "Jennifer", "Jessica", "Julia", "Karen", "Katharina", "Laura", "Linda", "Lisa", "Lucía", "Margaret", "Maria", "María", "Marie", "Mary", "Monika", "Nancy", "Patricia", "Petra", "Sabine", "Sandra", "Sarah", "Sophie", "Susan", "Ursula", "Victoria", "Virginia", "Aisha", "Fatima", "Mei", "Priya", "Sofia", "Yuki", "Анна", "Елена", "Екатерина", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна", "Άννα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"],
}
# What people introduce themselves or sign with.
INTRODUCTIONS = ["my name is", "My name is", "Name:", "name:", "Best regards,", "Kind regards,", "Regards,", "Sincerely,", "Yours sincerely,", "mein Name ist", "Mein Name ist", "Mit freundlichen Grüßen,", "je m'appelle", "Je m'appelle", "Cordialement,", "me llamo", "Me llamo", "Atentamente,", "меня зовут", "Меня зовут", "με λένε", "Με λένε"]
# Small words within names.
PARTICLES = ["van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "ter", "ten", "zu", "zur", "bin", "ibn", "al", "el"]
# Words that are no names where a name might stand, in lower case: groups, roles, small words, places, days.
NO_NAMES = frozenset("""
    all there world everyone everybody anyone team friend friends colleague colleagues customer customers client clients user users reader readers member members sir sirs madam folks guys people ladies gentlemen
    parents students neighbours neighbors community recruiter hiring manager developer engineer designer analyst architect director editor admin administrator support staff officer president universe america
    alle zusammen welt kollegen kolleginnen kunde kunden freunde leute tous toutes monde collègues amis client todos todas mundo amigos colegas cliente equipo все всем мир друзья коллеги κόσμε όλοι φίλοι
    and or nor but as at by for from in into is was are were be been of off on over the this that these those to up with without about after before has had have will would can could may might must shall should does did do not no if when where who
    und oder aber als am an auf aus bei das dem des die ein eine ist mit nach nicht sich war wie et ou mais est dans pour avec sur une un les sont qui que y e o en con por para es los las una и или но в на с по не
    again back here now then today tomorrow yesterday monday tuesday wednesday thursday friday saturday sunday january february march april june july august september october november december
    station street road avenue lane square airport falls university college school county river lake island park hotel bank church hospital bridge beach city town prize award cup league series project
""".split())
# Titles that are words or abbreviations of other things too; they need two names, or one that is known.
UNSURE = frozenset(["Sir", "Don", "Sr", "Miss", "Madam", "Mister"])
# Given names after which two family names follow.
TWO_FAMILIES = frozenset("José Juan Carlos Luis Manuel Miguel Pedro Antonio Ana Carmen Elena Isabel Laura Lucía Maria María".split())
# Calling codes of one digit, and the tens in which those of two lie, with those of them that three digits take.
ONE_DIGIT, TWO_DIGITS = "17", frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# Given names for surrogates by script and gender, and parts that family names are joined from.
GIVEN = {
    "LATIN": {"m": ["Anselm", "Bruno", "Cyril", "Dorian", "Emil", "Felix", "Hugo", "Magnus", "Oscar", "Rufus", "Simon", "Victor"], "f": ["Agatha", "Clara", "Diana", "Flora", "Greta", "Helena", "Ida", "Livia", "Nora", "Rosa", "Stella", "Vera"], "n": ["Alex", "Andrea", "Charlie", "Dominique", "Jona", "Kim", "Luca", "Noa", "Robin", "Sascha", "Toni", "Vanja"]},
    "CYRILLIC": {"m": ["Антон", "Виктор", "Глеб", "Егор", "Лев", "Максим", "Олег", "Роман", "Тимур", "Фёдор"], "f": ["Алла", "Вера", "Дарья", "Зоя", "Лидия", "Нина", "Полина", "Раиса", "Софья", "Юлия"], "n": ["Саша", "Женя", "Валя", "Слава", "Шура"]},
    "GREEK": {"m": ["Άρης", "Ηλίας", "Λουκάς", "Πέτρος", "Στέφανος", "Φώτης"], "f": ["Δάφνη", "Ζωή", "Ηρώ", "Θάλεια", "Μυρτώ", "Νεφέλη"], "n": ["Αλεξ", "Φοίβη", "Ίρις"]},
}
FAMILY = {
    "LATIN": (["Al", "Ber", "Cor", "Dal", "Fer", "Gal", "Hal", "Kel", "Lan", "Mar", "Nor", "Os", "Per", "Ran", "Sal", "Tor", "Ver", "Wal"], ["", "a", "de", "en", "i", "ma", "o", "ri", "ta", "ve"], ["berg", "dan", "feld", "ger", "len", "man", "nes", "rand", "son", "stin", "ton", "vik"]),
    "CYRILLIC": (["Бел", "Вол", "Гор", "Зим", "Кар", "Лаз", "Мор", "Нов", "Род", "Сок", "Тар", "Фом"], ["", "а", "е", "и", "о", "оле"], ["ин", "ов", "ев", "ский", "енко", "ук"]),
    "GREEK": (["Αθαν", "Βασιλ", "Δημητρ", "Κων", "Μακρ", "Νικολ", "Παπ", "Σταυρ"], ["", "α", "ι", "ο"], ["άκης", "ίδης", "όπουλος", "άς", "έας"]),
}
# Endings of family names of men, and of women.
GENDERED = [("ский", "ская"), ("цкий", "цкая"), ("ов", "ова"), ("ев", "ева"), ("ин", "ина"), ("όπουλος", "οπούλου"), ("άκης", "άκη"), ("ίδης", "ίδη"), ("άς", "ά"), ("έας", "έα")]
_DOMAINS = ("example.org", "example.net", "example.com")
_SYLLABLES = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
# What family names grow by with each redraw.
_MIDDLES = {"LATIN": _SYLLABLES, "CYRILLIC": [a + b for a in "бвгдзклмнпрст" for b in "аеио"], "GREEK": [a + b for a in "βγδκλμνπρστ" for b in "αεηιο"]}

_TITLE_OF = {t: g for g, titles in TITLES.items() for t in titles}
#: name, pattern; at one place the first that matches wins.
PATTERNS = (
    ("secret", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[0-9A-Za-z+/=\s]{16,65536}?-----END (?:[A-Z]+ )*PRIVATE KEY-----"),
    ("secret", r"(?<![0-9A-Za-z_-])eyJ[0-9A-Za-z_-]{8,4096}\.[0-9A-Za-z_-]{4,16384}\.[0-9A-Za-z_-]{4,4096}(?![0-9A-Za-z_.-])"),
    ("password", r"(?<!\w)(?i:password|passwd|passphrase|passwort|kennwort|contraseña|mot de passe|пароль)[\"']?(?: ?[:=] ?| is | ist | es | est )[\"']?(?P<pw>[^\s\"',;]*[0-9!@#$%^&*_+-][^\s\"',;]*)"),
    ("email", r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:){2,6}:)(?![0-9A-Za-z:]|\.[0-9])"),
    ("card", r"(?<![0-9-])(?:[0-9]{13,19}|[0-9]{4}(?:(?: [0-9]{4}){3}|(?:-[0-9]{4}){3}| [0-9]{6} [0-9]{5}|-[0-9]{6}-[0-9]{5}))(?![0-9]|-[0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    # without a country or brackets, area and exchange must be ones that are given out, or a trunk's 0 comes first
    ("phone", r"(?<![0-9+])(?:\+1[ .-]?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}|(?:1[ .-])?(?:\([0-9]{3}\)[ .-]?[0-9]{3}|[2-9][0-9]{2}[ .-][2-9][0-9]{2}))[ .-][0-9]{4}(?![0-9]|\.[0-9])"),
    ("phone", r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?|[0-9]{1,4}[ .-])[0-9]{3,8}(?:[ .-][0-9]{2,4}){0,3}|(?:\(0?[0-9]{2,4}\)[ .-]?|0[0-9]{1,3}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3})(?![0-9]|\.[0-9])"),
    ("phone", r"(?<![0-9+])\+[0-9]{8,15}(?![0-9])"),
)
FINDER = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p) in enumerate(PATTERNS)))
#: Those of PATTERNS that a text can only match if it has one of these, and all the others, which are looked for alone elsewhere.
RARE = {"-----BEGIN": "-----begin", "eyJ": "eyj", "(?P<pw>": ("passw", "passphrase", "kennwort", "contrase", "mot de passe", "пароль")}
_RARE_HINTS = tuple(w for ws in RARE.values() for w in ((ws,) if isinstance(ws, str) else ws))
_GROUPS = re.compile("[0-9A-Fa-f]:(?::|[0-9A-Fa-f]{1,4}:)")
USUAL = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p) in enumerate(PATTERNS) if not any(r in p for r in (*RARE, "{1,4}:"))))
_one_of = lambda words: "|".join(map(re.escape, sorted(words, key=len, reverse=True)))
_CAPITAL = r"[^\W\d_a-zа-яё]"
_NAME = rf"(?:{_CAPITAL}['’](?={_CAPITAL}))?{_CAPITAL}[^\W\d_]+(?:[-'’]{_CAPITAL}[^\W\d_]+)?"
_PART = rf"(?:(?:{_one_of(PARTICLES)}) ){{0,3}}"
_KNOWN_OF = {n: g for g, names in KNOWN.items() for n in names}
_loud = lambda words: _one_of({*words, *(w.upper() for w in words if w.isascii() and len(w) > 2)})
_TITLES, _KNOWN_NAMES = _one_of(_TITLE_OF), _loud(_KNOWN_OF)
#: A title, a salutation or an introduction and one or two names, or a frequent given name and one more, or two after some.
NAMES = re.compile(
    rf"(?<!\w)(?:(?P<title>{_TITLES})\.? {_PART}(?P<t1>{_NAME})(?: {_PART}(?P<t2>{_NAME}))?|(?:{_one_of({*SALUTATIONS, 'DEAR', 'HELLO'})}) (?!(?:{_TITLES})\b)(?P<s1>{_NAME})(?: {_PART}(?P<s2>{_NAME}))?"
    rf"|(?:{_one_of(INTRODUCTIONS)})\s(?!(?:{_TITLES})\b)(?P<i1>{_NAME}) {_PART}(?P<i2>{_NAME})|(?P<k1>{_KNOWN_NAMES}) {_PART}(?P<k2>{_NAME})(?: (?P<k3>{_NAME}))?)"
)
#: Without a digit or an @, a text has no entity but names and RARE ones; without one of these words or phrases, no name.
HINT = re.compile("[0-9@]")
_INTRODUCED = ("name is", "name:", "regards,", "sincerely,", "name ist", "grüßen,", "appelle", "cordialement,", "llamo", "atentamente,", "зовут", "λένε")
_WORD = re.compile(r"[^\W\d_]+")
_NAME_HINTS = frozenset(w for x in (*_TITLE_OF, *SALUTATIONS, *_KNOWN_OF, *(n.upper() for n in _KNOWN_OF), "DEAR", "HELLO") for w in _WORD.findall(x))
_HEX = re.compile("[0-9a-f]+|[0-9A-F]+")
_UNWANTED = re.compile("[^0-9A-Za-z]")


def canonical(kind: str, value: str) -> str:
    """What mentions of one entity have in common; of names, see named().

    A telephone number with its country begins with +, as does one of ten
    digits in the form that North America has, with or without its 1.
    """
    if kind == "phone":
        digits = _UNWANTED.sub("", value)
        if value.startswith("+") or (len(digits) == 11 and digits[0] == "1"):
            return "+" + digits
        return "+1" + digits if len(digits) == 10 and digits[0] not in "01" else digits
    if kind == "password":
        return value
    if kind in ("card", "ssn", "iban"):
        return _UNWANTED.sub("", value).upper()
    return value if kind == "secret" and not _HEX.fullmatch(value) else value.lower()


def family_of(name: str, gender: str) -> tuple[str, str]:
    """(canonical form, f or m): the family's name as its men have it.  Without a known gender, an ending of women's tells it."""
    low = name.lower()
    for man, woman in GENDERED:
        if gender != "m" and low.endswith(woman) and (gender == "f" or script_of(low) == "CYRILLIC"):
            return low[: -len(woman)] + man, "f"
    return low, "f" if gender == "f" else "m"


def named(m: re.Match) -> list[tuple[str, str, int, int, str]]:
    """(type, canonical form, start, end, gender) of the given and the family name of a match of NAMES.

    A given name's gender is that of the title, or that which the name itself is
    known for; it is a part of the canonical form.
    """
    name = {k: bool(v) and v[0].isupper() and v.lower() not in NO_NAMES for k, v in m.groupdict().items()}
    loud = m[0].isupper()
    first, second = next((a, b) for a, b in (("t1", "t2"), ("s1", "s2"), ("i1", "i2"), ("k1", "k2")) if m[a])
    if not name[first] or (first in ("k1", "i1") and not name[second]):
        return []
    if first == "k1" and m[first].isupper() and not m[second].isupper():
        return []
    if m["title"] in UNSURE and not name[second] and m[first].title() not in _KNOWN_OF:
        return []
    if first == "s1" and not loud and m[first].isupper() and len(m[first]) > 3:
        return []
    # what follows a title alone is a family's name
    given, family = (first, second if name[second] else None) if name[second] or first == "s1" else (None, first)
    gender = _TITLE_OF.get(m["title"], "n")
    out = []
    if given:
        known = _KNOWN_OF.get(m[given].title(), "n")
        gender = known if gender == "n" else gender
        out.append(("given", f"{gender}:{m[given].lower()}", *m.span(given), gender))
    if family:
        canon, form = family_of(m[family], gender)
        out.append(("family", canon, *m.span(family), form))
    if family == "k2" and name["k3"] and m["k1"] in TWO_FAMILIES:
        canon, form = family_of(m["k3"], gender)
        out.append(("family", canon, *m.span("k3"), form))
    return out


def _draw(key: bytes, *parts: object):
    """A function that gives keyed pseudo-random integers below its argument."""
    seed, state = "\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), [0, 0, 0]

    def below(n: int) -> int:
        if state[1] < 1 << 32:
            state[0] = int.from_bytes(hmac.digest(key, seed + b"\0%d" % state[2], "sha256"), "big")
            state[1], state[2] = 1 << 256, state[2] + 1
        state[0], out = divmod(state[0], n)
        state[1] //= n
        return out

    return below


def _luhn(digits: str) -> int:
    doubled = (int(d) * (1 + (i % 2)) for i, d in enumerate(reversed(digits)))
    return sum(x - 9 * (x > 9) for x in doubled) % 10


def script_of(word: str) -> str:
    name = next((unicodedata.name(c, "LATIN") for c in word if c.isalpha()), "LATIN").split()[0]
    return name if name in GIVEN else "LATIN"


def surrogate(kind: str, canon: str, key: bytes, attempt: int = 0) -> str:
    """The canonical form of the entity's surrogate.

    A name has as many more syllables as it was drawn again, so that there are
    enough for any number of entities.  A secret keeps what kind of sign is where.
    """
    draw = _draw(key, kind, canon, attempt)
    if kind == "email":
        return "".join(_SYLLABLES[draw(len(_SYLLABLES))] for _ in range(5)) + f"{draw(1000):03d}@{_SYLLABLES[draw(len(_SYLLABLES))]}{_SYLLABLES[draw(len(_SYLLABLES))]}.{_DOMAINS[draw(len(_DOMAINS))]}"
    if kind == "ip" and ":" in canon:
        return re.sub("[0-9a-f]+", lambda g: "".join("0123456789abcdef"[(k == 0) + draw(16 - (k == 0))] for k in range(len(g[0]))), canon)
    if kind == "ip":
        return ".".join(str(1 + draw(254)) for _ in range(4))
    if kind in ("given", "family"):
        gender, _, name = canon.partition(":") if kind == "given" else ("m", "", canon)
        script = script_of(name)
        names, (a, b, c), more = GIVEN[script][gender], FAMILY[script], _MIDDLES[script]
        middle = lambda: "".join(more[draw(len(more))] for _ in range(attempt))
        if kind == "family":
            return a[draw(len(a))] + b[draw(len(b))] + middle() + c[draw(len(c))]
        base = names[draw(len(names))]
        return f"{gender}:{base[:-1]}{middle()}{base[-1]}"
    like = lambda c: "0123456789"[draw(10)] if c.isdigit() else chr((65 if c.isupper() else 97) + draw(26)) if c.isalpha() else c
    if kind == "password":
        return "".join(map(like, canon))
    if kind == "secret":
        if canon.startswith("-----BEGIN"):
            head, body, tail = re.fullmatch(r"(-----[^-]+-----)(.*?)(-----[^-]+-----)", canon, re.DOTALL).groups()
            return head + "".join(map(like, body)) + tail
        head = next((p for p in ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "eyJ") if canon.startswith(p)), "")
        if not head:
            return "".join("0123456789abcdef"[draw(16)] for _ in canon)
        return head + "".join(map(like, canon[len(head) :]))
    if kind == "phone" and canon[0] == "+":  # the country stays; in North America area and exchange begin with 2 to 9
        head = 2 if canon[1] in ONE_DIGIT else 3 if canon[1:3] in TWO_DIGITS else 4
        return canon[:head] + "".join(str(2 + draw(8)) if canon[1] == "1" and k in (2, 5) else str(draw(10)) for k in range(head, len(canon)))
    out = [("0123456789"[draw(10)] if c.isdigit() else chr(65 + draw(26))) for c in canon]
    if kind == "phone":
        out[:1] = canon[:1]  # the trunk's 0 stays
    if kind == "iban":
        out[:2] = canon[:2]
        number = int("".join(str(int(c, 36)) for c in [*out[4:], *out[:2]]) + "00")
        out[2:4] = f"{98 - number % 97:02d}"
    if kind == "card":
        out[0] = canon[0]
        if _luhn(canon) == 0:
            out[-1] = str((10 - _luhn("".join(out[:-1]) + "0")) % 10)
    return "".join(out)


def in_format_of(kind: str, value: str, canon: str, form: str = "") -> str:
    """A canonical surrogate, laid out and cased as the mention it stands for, and of its gender."""
    if kind in ("phone", "card", "ssn", "iban"):
        own, all_ = sum(c.isalnum() and c.isascii() for c in value), _UNWANTED.sub("", canon)
        letters = iter(all_[len(all_) - own :])  # a mention may lack the country
        return "".join(next(letters) if c.isalnum() and c.isascii() else c for c in value)
    if kind == "password" or (kind == "secret" and not _HEX.fullmatch(value)):
        return canon
    if kind == "given":
        canon = canon.partition(":")[2]
    if kind == "family" and form == "f":
        canon = next((canon[: -len(man)] + woman for man, woman in GENDERED if canon.endswith(man)), canon)
    if kind in ("given", "family"):
        return canon.upper() if value.isupper() else canon
    return canon.upper() if value.upper() == value and value.lower() != value else canon


def entities_of(text: str) -> list[tuple[str, str, int, int, str]]:
    """(type, canonical form, start, end, gender) of every entity in the text, in code points, in order.

    Numbers of a card's length are cards if their check digit fits.  A form of
    address isn't part of a name.
    """
    found = []
    low = text.lower()
    rare = any(w in low for w in _RARE_HINTS) or _GROUPS.search(text)
    if rare or HINT.search(text):
        for m in (FINDER if rare else USUAL).finditer(text):
            kind, value = PATTERNS[int(m.lastgroup[1:])][0], m[0]  # the outer group closes last
            if kind == "password":
                found.append((kind, m["pw"], *m.span("pw"), ""))
            elif kind != "card" or _luhn(_UNWANTED.sub("", value)) == 0:
                found.append((kind, canonical(kind, value), *m.span(), ""))
    if not _NAME_HINTS.isdisjoint(_WORD.findall(text)) or any(w in low for w in _INTRODUCED):
        names = [x for m in NAMES.finditer(text) for x in named(m)]
        if names:
            found = sorted(found + names, key=lambda x: x[2])
            found = [x for k, x in enumerate(found) if not k or x[2] >= max(y[3] for y in found[max(0, k - 4) : k])]
    return found


def find(text: str) -> list[tuple[str, int, int]]:
    """(type, start, end) of every entity in the text."""
    return [(kind, a, b) for kind, _, a, b, _ in entities_of(text)]


def mentions(docs: DataFrame) -> DataFrame:
    """(id, kind, canon), once a document, of docs(id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2 << 20):
            at, kinds, canons = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                for kind, canon in sorted({x[:2] for x in entities_of(text or "")}):
                    at.append(k)
                    kinds.append(kind)
                    canons.append(canon)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(canons, pa.string())], ["id", "kind", "canon"])

    id_kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {id_kind}, kind string, canon string")


def drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """entities(kind, canon, attempt) with their canonical surrogates in fake."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            made = ((kind, surrogate(kind, canon, key, attempt)) for kind, canon, attempt in rows)
            fake = [x.lower() if kind in ("given", "family") else canonical(kind, x) for kind, x in made]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fake, pa.string())], ["kind", "canon", "attempt", "fake"])

    return entities.select("kind", "canon", "attempt").mapInArrow(run, "kind string, canon string, attempt int, fake string")


def settled(entities: DataFrame, key: bytes, most: int = 64) -> DataFrame:
    """(kind, canon, attempt) of the entities(kind, canon) that need more than their first draw.

    An entity draws again while its surrogate is an original, or that of an
    entity with a lesser canonical form.  Raises if clashes are left after
    `most` draws, which means that a format of numbers is too small for its
    entities; names have room for any number of them.
    """
    # given names of any gender must differ
    bare = lambda c: F.when(F.col("kind") == "given", F.substring(c, 3, 1 << 20)).otherwise(F.col(c))
    now = written(drawn(entities.withColumn("attempt", F.lit(0)), key))
    for attempt in range(1, most + 1):
        made = now.withColumn("fake", bare("fake"))
        taken = entities.select("kind", bare("canon").alias("fake"), F.lit(True).alias("_original")).distinct()
        first = made.groupBy("kind", "fake").agg(F.min(F.struct("attempt", "canon"))["canon"].alias("_owner"))
        clash = made.join(taken, ["kind", "fake"], "left").join(first, ["kind", "fake"]).where("_original or canon <> _owner").select("kind", "canon")
        clash = written(clash)
        if clash.isEmpty():
            return now.where("attempt > 0").select("kind", "canon", "attempt")
        again = drawn(clash.withColumn("attempt", F.lit(attempt)), key)
        now = written(now.join(clash, ["kind", "canon"], "left_anti").unionByName(again))
    raise ValueError(f"surrogates still clash after {most} draws")


ENTITY = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("surrogate", pa.string())])


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs, with surrogates in text_col, n_entities, and entities (kind, start in the new text, surrogate).

    One entity has one surrogate in all texts, and no two have the same; none is
    an entity of the input.  A null text stays null and has no entities; ids may
    repeat or be null.  Columns named n_entities and entities are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_entities", "entities")]
    base = docs.select(F.struct(*map(named_column, names)).alias("doc"), named_column(id_col).alias("id"), named_column(text_col).cast("string").alias("text"))
    seen = written(mentions(base))
    late = written(settled(seen.select("kind", "canon").distinct(), key))
    if late.isEmpty():
        given = base.select("doc", F.lit(None).cast("array<struct<kind:string,canon:string,attempt:int>>").alias("late"))
    else:  # the mentions of entities that drew again, by document; Spark broadcasts them only if they are few
        again = written(seen.join(late, ["kind", "canon"]).groupBy("id").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("late")).withColumnRenamed("id", "of"))
        given = base.join(again, F.col("id").eqNullSafe(F.col("of")), "left").select("doc", "late")
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2 << 20):
            own, texts, found = batch.column(0).flatten(), [], []
            for text, late_ones in zip(own[place].cast(pa.string()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                attempts = {(x["kind"], x["canon"]): x["attempt"] for x in late_ones or ()}
                parts, rows, at, size = [], [], 0, 0
                for kind, canon, a, b, form in entities_of(text or ""):
                    new = in_format_of(kind, text[a:b], surrogate(kind, canon, key, attempts.get((kind, canon), 0)), form)
                    size += a - at
                    rows.append({"kind": kind, "start": size, "surrogate": new})
                    size += len(new)
                    parts += [text[at:a], new]
                    at = b
                texts.append(text if not rows else "".join([*parts, text[at:]]))
                found.append(rows)
            own[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*own, pa.array(map(len, found), pa.int64()), pa.array(found, pa.list_(ENTITY))], [*names, "n_entities", "entities"])

    entity = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("surrogate", StringType())]))
    fields = [StructField(f.name, StringType() if f.name == text_col else f.dataType) for f in (docs.schema[n] for n in names)]
    return given.mapInArrow(run, StructType([*fields, StructField("n_entities", LongType()), StructField("entities", entity)]))
