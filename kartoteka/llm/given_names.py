"""Given names: their spellings, short forms and foreign forms, brought to one name. The lists are a seed; :mod:`learned_names`
adds the forms that the data show."""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import regex

from kartoteka.llm.p4_forms import ORDINARY, surface

# Given names of the region.
NAMES = """Adam Agnieszka Anna Antoni Antonina Apolonia Barbara Bartłomiej Bolesław Bronisława Cecylia Cyprian Dominik Dorota
Edward Elżbieta Emilia Ernest Eustachy Ewa Feliks Franciszek Franciszka Gabriela Genowefa Grzegorz Gustaw Helena Henryk
Hieronim Honorata Ignacy Jadwiga Jakub Jan Julia Julian Józef Józefa Karol Karolina Katarzyna Kazimierz Leokadia Leon Ludwik
Ludwika Magdalena Maria Marianna Michał Narcyz Natalia Olimpia Onufry Oskar Paulina Paweł Petronela Piotr Rajmund Roman
Rozalia Sabina Stanisław Stanisława Tekla Teofil Teresa Tomasz Urban Urszula Walenty Walerian Weronika Wiktoria Wojciech Zofia
Zuzanna Zygmunt""".split()
# Short forms.
SHORT = dict(
    x.split("=")
    for x in """Adamek=Adam Adaś=Adam Agusia=Agnieszka Ania=Anna Hanka=Anna Antek=Antoni Tosia=Antonina Pola=Apolonia Basia=Barbara
Bartek=Bartłomiej Bolek=Bolesław Bronia=Bronisława Bronka=Bronisława Cesia=Cecylia Cypek=Cyprian Domek=Dominik Dosia=Dorota
Edek=Edward Ela=Elżbieta Milka=Emilia Ernestek=Ernest Eustasiek=Eustachy Ewka=Ewa Felek=Feliks Franek=Franciszek Frania=Franciszka
Gabrysia=Gabriela Gienia=Genowefa Grześ=Grzegorz Gucio=Gustaw Hela=Helena Lena=Helena Heniek=Henryk Hirek=Hieronim
Honorka=Honorata Ignaś=Ignacy Jadzia=Jadwiga Kuba=Jakub Janek=Jan Jaś=Jan Iwan=Jan Julka=Julia Jula=Julia Julek=Julian Józek=Józef
Ziutek=Józef Józia=Józefa Karolek=Karol Karolcia=Karolina Kasia=Katarzyna Kazik=Kazimierz Kazio=Kazimierz Lodzia=Leokadia
Lonek=Leon Lutek=Ludwik Lusia=Ludwika Magda=Magdalena Mania=Maria Marysia=Maria Marianka=Marianna Michałek=Michał Misza=Michał
Narcyzek=Narcyz Natka=Natalia Olimpka=Olimpia Nufrek=Onufry Oskarek=Oskar Paulinka=Paulina Pawełek=Paweł Petra=Petronela
Piotrek=Piotr Mundek=Rajmund Romek=Roman Rózia=Rozalia Sabinka=Sabina Staszek=Stanisław Stach=Stanisław Stasia=Stanisława
Teklusia=Tekla Filek=Teofil Tereska=Teresa Tomek=Tomasz Urbanek=Urban Ula=Urszula Walek=Walenty Walerek=Walerian Werka=Weronika
Wikta=Wiktoria Wojtek=Wojciech Zosia=Zofia Zuzia=Zuzanna Zygmuś=Zygmunt""".split()
)
# German and Latin forms.
FOREIGN = dict(
    x.split("=")
    for x in """Agnes=Agnieszka Anne=Anna Anton=Antoni Antonie=Antonina Apollonia=Apolonia Barbe=Barbara Bartholomäus=Bartłomiej
Boleslaus=Bolesław Cäcilie=Cecylia Cyprianus=Cyprian Dominicus=Dominik Dorothea=Dorota Eduard=Edward Elisabeth=Elżbieta
Emilie=Emilia Ernst=Ernest Eustachius=Eustachy Eva=Ewa Felix=Feliks Franz=Franciszek Franziska=Franciszka Gabriele=Gabriela
Genoveva=Genowefa Gregor=Grzegorz Gustav=Gustaw Helene=Helena Heinrich=Henryk Hieronymus=Hieronim Honorate=Honorata
Ignatz=Ignacy Hedwig=Jadwiga Jakob=Jakub Johann=Jan Josef=Józef Josepha=Józefa Julie=Julia Julianus=Julian Karl=Karol
Karoline=Karolina Katharina=Katarzyna Leokadie=Leokadia Leo=Leon Ludwig=Ludwik Luise=Ludwika Marie=Maria Marianne=Marianna
Michael=Michał Narcissus=Narcyz Natalie=Natalia Olympia=Olimpia Onuphrius=Onufry Oscar=Oskar Pauline=Paulina Paul=Paweł
Petronella=Petronela Peter=Piotr Raimund=Rajmund Romanus=Roman Rosalie=Rozalia Sabine=Sabina Stanislaus=Stanisław Thekla=Tekla
Theophil=Teofil Therese=Teresa Thomas=Tomasz Urbanus=Urban Ursula=Urszula Valentin=Walenty Valerian=Walerian Veronika=Weronika
Viktoria=Wiktoria Adalbert=Wojciech Sophie=Zofia Susanna=Zuzanna Sigismund=Zygmunt""".split()
)
# Cyrillic letters and how Polish writes them.
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщыьэюяёіѓў", "a b w g d e ż z i j k l m n o p r s t u f ch c cz sz szcz y ' e ju ja jo i g u".split()))
CYRILLIC["х"] = "h"
#: What stands for a missing given name.
FILLERS = {"bd", "nieczyt", "nieczytelne", "brak", "nn", "nieznane", "nieznany", "nieznana", "jw", "x"}


def latin(text: str) -> str:
    """Cyrillic letters in Polish spelling, in lower case; other letters as they are."""
    return "".join(CYRILLIC.get(c, c) for c in text.lower()).replace("'", "") if any("Ѐ" <= c <= "ӿ" for c in text) else text.lower()


#: Polish letters and what is left of them without their marks.
_UNMARKED = str.maketrans("ąćęłńóśźż", "acelnoszz")
_ORDINARY = regex.compile(ORDINARY)


def plain(text: str) -> str:
    """Lower-case letters without accents; everything else is dropped."""
    if _ORDINARY.match(text):  # the same as below, for the letters that nearly all values have
        text = text.lower().translate(_UNMARKED)
        return text if text.isalpha() else "".join(filter(str.isalpha, text))
    text = unicodedata.normalize("NFD", latin(surface(text)).replace("ł", "l"))
    return "".join(c for c in text if c.isalpha())


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with adjacent exchanges, ``most + 1`` if above ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for x, ca in enumerate(a):
        now = [x + 1]
        for y, cb in enumerate(b):
            best = min(row[y] + (ca != cb), row[y + 1] + 1, now[y] + 1)
            if x and y and ca == b[y - 1] and a[x - 1] == cb:
                best = min(best, before[y - 1] + 1)
            now.append(best)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


def _shortened(word: str, most: int) -> set[str]:
    out = {word}
    for _ in range(most):
        out |= {w[:i] + w[i + 1 :] for w in out for i in range(len(w))}
    return out


def _edits(word: str) -> int:
    return 2 if len(word) >= 5 else 1 if len(word) >= 3 else 0


#: Remembered tokens of one worker.
MEMO = 200_000


@dataclass
class Names:
    """Known forms of given names (plain) and the name each stands for."""

    forms: dict[str, str]

    def __post_init__(self) -> None:
        self.near: dict[str, list[str]] = defaultdict(list)
        for form in self.forms:
            for w in _shortened(form, _edits(form)):
                self.near[w].append(form)
        self.memo: dict[str, tuple[str, ...]] = {}

    def __reduce__(self):
        return Names, (self.forms,)

    def is_given(self, token: str) -> bool:
        """Whether the token is a known form, letter for letter but for accents and case."""
        return plain(token) in self.forms

    def of(self, token: str) -> tuple[str, ...]:
        """The given names that a typed token can stand for: known forms letter for letter, else the nearest known ones; at two
        edits only if there is just one."""
        if token not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = self._of(plain(token))
        return self.memo[token]

    def _of(self, word: str) -> tuple[str, ...]:
        if word in self.forms:
            return (self.forms[word],)
        found: dict[str, int] = {}
        for w in _shortened(word, _edits(word)) if 3 <= len(word) <= 14 else ():
            for form in self.near.get(w, ()):
                most = min(_edits(form), max(_edits(word), 1))
                if (d := osa(word, form, most)) <= most:
                    found[self.forms[form]] = min(found.get(self.forms[form], 9), d)
        best = min(found.values(), default=0)
        names = tuple(sorted(n for n, d in found.items() if d == best))
        return names if best < 2 or len(names) == 1 else ()


@lru_cache(maxsize=4)
def seed(without: frozenset[str] = frozenset()) -> Names:
    """The lists above, but for the plain forms in ``without``; forms of a name that is left out stand for the first of them."""
    every = {plain(n): plain(n) for n in NAMES} | {plain(k): plain(v) for k, v in {**FOREIGN, **SHORT}.items()}
    kept = {f: n for f, n in every.items() if f not in without}
    heads: dict[str, str] = {}
    for f, n in kept.items():
        heads.setdefault(n, n if n in kept else f)
    return Names({f: heads[n] for f, n in kept.items()})
