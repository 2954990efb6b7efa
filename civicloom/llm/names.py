"""Parts of personal names, however written."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

# Given names and their short forms, one group a line.
SHORT_FORMS = """
abigail abby gail
albert al bert
alexander alex alec sandy
alexandra alex sandra sandy
andrew andy drew
anthony tony
barbara barb barbie babs
benjamin ben benj benny
catherine cathy kate kathy katie cat
charles chuck charlie chas
christine chris chrissy tina
christopher chris topher kit
cynthia cindy
daniel dan danny
deborah deb debbie debby
donald don donny
dorothy dot dottie dolly
douglas doug
edward ed eddie ted ned edw
eleanor nell ellie nora
elizabeth liz beth betty eliza lizzie betsy
eugene gene
florence flo florrie
frances fran frankie
francis frank fran
frederick fred freddy fredk
gabriela gabi gaby
george geo
gerald jerry gerry
gregory greg
harold hal harry
henry hank harry
jacqueline jackie
james jim jimmy jas
jeffrey jeff
jennifer jen jenny
john jack johnny jno
jose pepe
joseph joe joey jos
josephine jo josie
judith judy
kathleen kathy kate
kenneth ken kenny
lawrence larry
leonard len lenny leo
madeleine maddie
margaret peggy meg maggie marge
matthew matt
michael mike mick
nathaniel nate nat
pamela pam
patricia pat patty tricia
patrick pat
peter pete
philip phil
raymond ray
rebecca becky becca
richard dick rick rich
robert bob rob bobby robt
ronald ron ronnie
samantha sam
samuel sam saml
sandra sandy
stephen steve steph
susan sue susie
theodore ted teddy theo
theresa terry tess
thomas tom tommy thos
timothy tim
veronica ronnie vera
victoria vicky vicki
vincent vince vin
virginia ginny
walter walt
william bill billy will wm
zachary zach zack
"""
# Fixed values.
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "2", "iii": "3", "iv": "4", "2nd": "2", "3rd": "3"}
PARTICLES = {"de", "la", "del", "der", "den", "van", "von", "di", "da", "du", "le", "st", "mac", "los", "las"}

_BOOK: dict[str, frozenset[str]] = {}
for _line in SHORT_FORMS.split("\n"):
    for _word in _line.split():
        _BOOK[_word] = _BOOK.get(_word, frozenset()) | {_line.split()[0]}


def fold(text: str) -> str:
    """Lower case, without accents or characters that aren't seen."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()


@lru_cache(maxsize=4096)
def roots(given: str) -> frozenset[str]:
    """The full names a given name may stand for, itself if none is known."""
    return _BOOK.get(given, frozenset()) | ({given} if given not in _BOOK else frozenset())


@dataclass(frozen=True)
class Name:
    """A name's parts, folded; ``last`` has letters only."""

    last: str
    first: str
    middle: tuple[str, ...]
    suffix: str
    nick: str
    also: tuple[str, ...]


def _letters(text: str) -> str:
    return re.sub("[^a-z]", "", text)


def parse_name(text: str, family: str | None = None) -> Name | None:
    """Parts of "LAST, First Middle, Suffix (Nick)" or "First Middle Last, Suffix"; None if there is no letter.

    ``family`` tells which words at the end are the last name, where it is known.
    """
    nick = re.search(r"\(([^)]*)\)|\"([^\"]*)\"", text)
    bare = re.sub(r"\([^)]*\)|\"[^\"]*\"", " ", text)
    raw_parts = [p.strip() for p in bare.split(",")]
    suffix = ""
    parts = []
    for p in raw_parts:
        words = p.split()
        while words and _letters_or_digits(fold(words[-1])) in SUFFIXES and (len(words) > 1 or parts):
            suffix = suffix or SUFFIXES[_letters_or_digits(fold(words[-1]))]
            words.pop()
        if words:
            parts.append(words)
    if not parts:
        return None
    if len(parts) > 1:
        last_words, given = parts[0], [w for p in parts[1:] for w in p]
    else:
        words = parts[0]
        k = 1
        if family and len(family.split()) < len(words):
            k = len(family.split())
        else:
            while k < len(words) - 1 and (fold(words[-k - 1]) in PARTICLES or (words[-1].isupper() and len(words[-1]) > 1 and words[-k - 1].isupper() and len(_letters(fold(words[-k - 1]))) > 1)):
                k += 1
        last_words, given = words[-k:], words[:-k]
    last = _letters(fold("".join(last_words)))
    given_folded = [g for w in given if (g := _letters(fold(w)))]
    if not last and not given_folded:
        return None
    hyphen = [h for w in last_words for p in fold(w).split("-") if (h := _letters(p)) and len(h) > 3 and h != last]
    first, middle = (given_folded[0], tuple(given_folded[1:])) if given_folded else ("", ())
    also = tuple(dict.fromkeys([*hyphen, *[m for m in middle if len(m) > 3]]))
    nick_text = _letters(fold((nick.group(1) or nick.group(2) or "") if nick else ""))
    return Name(last, first, middle, suffix, nick_text, also)


def _letters_or_digits(text: str) -> str:
    return re.sub("[^a-z0-9]", "", text)


def edit_distance(a: str, b: str, most: int = 99) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two strings, ``most`` at most."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) >= most:
        return most
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row[j] = d
    return min(most, row[-1])

