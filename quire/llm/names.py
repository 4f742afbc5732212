"""Reading names as people type them: titles, nicknames, organisations, word order."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# Titles by the gender they show.
MALE_TITLES = {"mr", "mister", "sir", "lord", "master", "monsieur", "herr", "don", "baron", "father", "brother", "duke", "count", "esq"}
FEMALE_TITLES = {"mrs", "miss", "ms", "lady", "madam", "madame", "mme", "mlle", "frau", "dona", "dame", "baroness", "sister", "duchess", "countess"}
OTHER_TITLES = {
    "dr", "doctor", "prof", "professor", "rev", "reverend", "capt", "captain", "col", "colonel", "gen", "general", "major",
    "sergeant", "sgt", "lieutenant", "lieut", "lt", "judge", "canon", "squire", "bailiff", "hon", "bishop", "dean", "vicar",
    "admiral", "inspector", "constable", "messrs",
}
LONG_TITLE = {"doctor": "dr", "mister": "mr", "capt": "captain", "col": "colonel", "gen": "general", "rev": "reverend", "sgt": "sergeant", "lieut": "lieutenant", "lt": "lieutenant", "prof": "professor"}
TITLES = MALE_TITLES | FEMALE_TITLES | OTHER_TITLES

# Common English short forms of given names.
NICKNAMES: dict[str, tuple[str, ...]] = {
    name: tuple(full.split())
    for name, full in (
        line.split(": ")
        for line in """\
abby: abigail
addie: adelaide adeline
alf: alfred
amby: ambrose
andy: andrew
annie: anne anna
archie: archibald
bart: bartholomew
bartie: bartholomew
bat: bartholomew
becky: rebecca
bell: isabella
bella: isabella
belle: isabella
ben: benjamin
bert: albert gilbert herbert robert
bertie: albert gilbert herbert
bess: elizabeth
bessie: elizabeth
beth: elizabeth
betsy: elizabeth
betty: elizabeth
bill: william
billy: william
bob: robert
bobby: robert
brose: ambrose
carrie: caroline
charley: charles charlotte
charlie: charles charlotte
chris: christopher
dick: richard
dolly: dorothy
dora: dorothy theodora
dot: dorothy
dottie: dorothy
ed: edward edmund
eddie: edward edmund
eliza: elizabeth
ella: eleanor
ellen: eleanor helen
ellie: eleanor
fan: frances
fannie: frances
fanny: frances
fran: frances
frank: francis
frankie: frances francis
fred: frederick
freda: winifred
freddie: frederick winifred
freddy: frederick
gil: gilbert
gus: augustus augusta
gussie: augusta
hal: henry harold
hank: henry
harry: henry harold
hattie: harriet
hatty: harriet
hetty: harriet henrietta
ibby: isabella elizabeth
jack: john
jem: james
jenny: jane
jim: james
jo: josephine joseph
joe: joseph
josie: josephine
kate: katherine catherine
kathy: katherine catherine
katie: katherine catherine
kit: christopher katherine
kitty: katherine catherine
larry: laurence
leo: leonora leonard leopold
liz: elizabeth
liza: elizabeth
lizzie: elizabeth
lottie: charlotte
lotty: charlotte
madge: margaret
mag: margaret
maggie: margaret
may: mary
meg: margaret
mick: michael
minnie: wilhelmina
moll: mary
molly: mary
nan: anne nancy
nat: nathaniel
nate: nathaniel
ned: edward edmund
nell: eleanor helen
nellie: eleanor helen
nelly: eleanor helen
nick: nicholas
nora: leonora eleanor honora
peg: margaret
peggy: margaret
phil: philip
poll: mary
polly: mary
rich: richard
rick: richard
rob: robert
robbie: robert
robin: robert
sal: sarah
sally: sarah
sam: samuel
sammy: samuel
sukey: susannah susan
sue: susannah susan
susan: susannah
susie: susannah susan
ted: theodore edward
teddy: theodore edward
theo: theodore
tibby: isabella elizabeth
tilly: matilda
tim: timothy
tolly: bartholomew
tom: thomas
tommy: thomas
tony: anthony
wat: walter
will: william
willie: william
win: winifred
winnie: winifred
winny: winifred
zach: zachariah
zack: zachariah
zak: zachariah""".splitlines()
    )
}

# Words that make a name that of an organisation, strongest first.
ORGANISATION_KINDS = (
    ("hospital", {"hospital", "hosp", "infirmary"}),
    ("bank", {"bank", "bnk"}),
    ("sons", {"sons", "son"}),
    ("brothers", {"bros", "brothers", "bro"}),
    ("society", {"society", "soc", "club", "guild", "library", "school", "college", "academy"}),
    ("company", {"company", "compy", "comp", "co", "cie", "ltd", "limited"}),
)
_ORG_WORDS = set().union(*(w for _, w in ORGANISATION_KINDS))
_FILLERS = {"the", "of", "and", "messrs", "st", "saint", "ltd", "limited", "at", "in"}


class Form(NamedTuple):
    """One way to read a name: kind full, initial, title, org or figure."""

    kind: str
    surname: str
    given: str
    middle: str
    title: str
    gender: str


def letters(word: str) -> str:
    """Lower-case letters and digits only, accents off."""
    flat = unicodedata.normalize("NFKD", word).casefold()
    return "".join(c for c in flat if c.isalnum())


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[\s,;&]+|(?<=\w)\.(?=\w\w)", name) if letters(w)]


def title_gender(title: str) -> str:
    return "male" if title in MALE_TITLES else "female" if title in FEMALE_TITLES else ""


def read_name(name: str | None) -> list[Form]:
    """All readings of a typed name; none for null, blank or sign-only names."""
    words = _words(name or "")
    if not words:
        return []
    plain = [letters(w) for w in words]
    if len(plain) > 1 and any(p in _ORG_WORDS for p in plain):
        return [_organisation(plain, words)]
    titles = []
    while plain and plain[0] in TITLES:
        titles.append(LONG_TITLE.get(plain[0], plain[0]))
        plain, words = plain[1:], words[1:]
    while len(plain) > 1 and plain[-1] in {"esq", "jr", "sr", "junior", "senior"}:
        plain, words = plain[:-1], words[:-1]
    title = titles[0] if titles else ""
    gender = next((g for g in map(title_gender, titles) if g), "")
    # "A." and a capital before a capital are initials, not articles
    article = bool(words) and (words[0] in {"a", "an"} or words[0] in {"A", "An"} and words[1:2] == [x.lower() for x in words[1:2]])
    if not plain or article or plain[0] in {"the", "old", "young", "la", "le", "der", "die", "das"}:
        if plain == ["the", title] or not plain:
            plain = ["the", title]
        return [Form("figure", " ".join(plain), "#figure", "", "", "")]
    if len(plain) == 1:
        return [Form("title", plain[0], "", "", title, gender)] if title else [Form("single", plain[0], "", "", "", "")]
    if "," in name:  # surname, given names
        first = len(_words(name.split(",")[0]))
        first -= len(titles) if name.split(",")[0].strip().casefold().startswith(tuple(TITLES)) and titles else 0
        plain = plain[max(1, first) :] + plain[: max(1, first)]
    short = [p for p in plain if len(p) == 1]
    long = [p for p in plain if len(p) > 1]
    if len(long) == 1:
        return [Form("initial", long[0], short[0], "", title, gender)] if short else []
    if len(long) >= 2:
        given, surname = long[0], "".join(long[1:]) if len(long) > 2 else long[1]
        middle = short[0] if short and plain[0] not in short else ""
        return [Form("full", surname, given, middle, title, gender)]
    return [Form("figure", " ".join(plain), "#figure", "", "", "")]


def _organisation(plain: list[str], words: list[str]) -> Form:
    kind = next(k for k, own in ORGANISATION_KINDS if own & set(plain))
    core = []
    for p, w in zip(plain, words):
        if p in _ORG_WORDS or p in _FILLERS:
            continue
        if re.search(r"['’]s$", w) or kind == "hospital" and p.endswith("s") and "of" not in plain:
            p = p[:-1]
        core.append(p)
    return Form("org", "".join(sorted(core)) or "".join(plain), f"#{kind}", "", "", "")


def full_givens(given: str, nicknames: dict[str, tuple[str, ...]] = NICKNAMES) -> tuple[str, ...]:
    """The given names a typed one may stand for; a full name stands for itself."""
    return nicknames.get(given, (given,))
