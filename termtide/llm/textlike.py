"""How likely a token is as text, written plainly or encoded, against uniform symbols.

Text is a chain over bytes: the class of the next byte (lower, upper, digit, mark, other) given the class
before, and the letter given the letter before, from pairs counted in `WORDS` (fixed, smoothed). A token is
read as it stands, with case folded, and decoded from its alphabet; the likeliest reading counts. The
ratio of the uniform to the text probability is at least x with probability 1 / x at most where the token
is text, so 1 / ratio is a p-value of "is text" that loses no power on short or on long tokens.
"""

from __future__ import annotations

import math

import numpy as np

#: Frequent words of English, German, French and Spanish, and of names in programs.
WORDS = """
the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their
we him been has when who will no more if out so said what up its about than into them can only other time new some could these two may first then do any
like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long
people state world still between life being under never same another know while last might great year since against right came take himself few house
use during without again place around however home small found general thought went say part once high upon school every does got united left number
der die und das von den mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie
einem einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei hatte kann gegen vom schon wenn habe seine ihre dann unter wir soll
le la les des et en un une du que est pour qui dans par plus pas au sur ne se ce il sont avec son aux mais comme ou si leur elle nous tout deux cette
el los las del una por con para como pero sus este entre cuando muy sin sobre tambien hasta hay donde quien desde todo nos durante estados todos uno
ni contra otros ese eso ante ellos esto antes algunos porque unos yo otro otras
get set add remove delete update create value name type list string number index count size length key data file path user item node table column row
test config default version release build source target service client server request response session handler manager factory controller context
internal external processing statement configure overview assessment notes document application component container network message package module
function method parameter result error exception status state event action process system component information management development production
content header footer image style script button input output format template model view page site link address start end begin finish open close read
write query search filter sort group project project task report account access public private static final import export upload download
""".split()
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LOWER, UPPER, DIGIT, MARK, OTHER = range(5)
#: Chance of the next class (columns) after each class (rows).
STEP = np.array([
    [0.78, 0.09, 0.04, 0.088, 0.002], [0.62, 0.21, 0.08, 0.088, 0.002], [0.06, 0.06, 0.68, 0.198, 0.002], [0.42, 0.22, 0.30, 0.058, 0.002], [0.40, 0.05, 0.05, 0.10, 0.40],
])
#: The same where case is folded away.
FOLDED = np.array([[0.87, 0.0, 0.04, 0.088, 0.002], [0.87, 0.0, 0.04, 0.088, 0.002], [0.12, 0.0, 0.68, 0.198, 0.002], [0.64, 0.0, 0.30, 0.058, 0.002], [0.45, 0.0, 0.05, 0.10, 0.40]])


def _classes() -> np.ndarray:
    out = np.full(256, OTHER)
    out[32:127] = MARK
    for c, low, high in ((LOWER, "a", "z"), (UPPER, "A", "Z"), (DIGIT, "0", "9")):
        out[ord(low) : ord(high) + 1] = c
    return out


def _table(step: np.ndarray, smoothing: float) -> np.ndarray:
    """Natural logarithms of the chance of each byte after each byte; smoothing: what is added to the count of each pair."""
    pairs, singles = np.full((26, 26), smoothing), np.full(26, 1.0)
    for word in WORDS:
        at = [ord(c) - 97 for c in word]
        np.add.at(singles, at, 1)
        np.add.at(pairs, (at[:-1], at[1:]), 1)
    pairs /= pairs.sum(axis=1, keepdims=True)
    singles /= singles.sum()
    kind = _classes()
    letter = np.where((kind == LOWER), np.arange(256) - 97, np.where(kind == UPPER, np.arange(256) - 65, -1))
    within = np.empty((256, 256))
    within[:, :] = np.array([0, 0, 1 / 10, 1 / 34, 1 / 161])[kind][None, :]
    within[:, 32] = np.where(kind[32] == MARK, 0.5, within[:, 32])
    has = letter >= 0
    within[:, has] = singles[letter[has]][None, :]
    within[np.ix_(has, has)] = pairs[np.ix_(letter[has], letter[has])]
    # a capital behind a small letter begins a word, of which the letter before tells nothing
    low, up = np.flatnonzero(kind == LOWER), np.flatnonzero(kind == UPPER)
    within[np.ix_(low, up)] = (singles + 1 / 26)[letter[up]][None, :] / 2
    return np.log(np.maximum(step[kind[:, None], kind[None, :]] * within, 1e-12))


#: Tokens of both cases have evidence to spare, so their words may be less like the listed ones.
CASED, FOLD = _table(STEP, 1.5), _table(FOLDED, 0.3)


def _chance(raw: bytes, table: np.ndarray) -> float:
    at = np.frombuffer(b"-" + raw, np.uint8)
    return float(table[at[:-1], at[1:]].sum())


def decoded(at: list[int], bits: int) -> bytes:
    """The bytes that symbol numbers of so many bits write, the last symbols' rest left out."""
    total = len(at) * bits
    number = 0
    for chunk in range(0, len(at), 64):
        part = at[chunk : chunk + 64]
        low = 0
        for a in part:
            low = low << bits | a
        number = number << bits * len(part) | low
    return (number >> total % 8).to_bytes(total // 8, "big") if total >= 8 else b""


def evidence(token: str, at: list[int], k: int) -> float:
    """Natural logarithm of the uniform over the text probability of a token with symbol numbers `at` of k."""
    plain = token.rstrip("=")
    # dashes that the symbols leave out are not symbols of either side
    if len(at) < len(plain):
        plain = plain.replace("-", "").replace("_", "")
    raw = plain.encode()
    mixed = raw.upper() != raw != raw.lower()
    text = _chance(raw, CASED) if mixed else _chance(raw.lower(), FOLD)
    hidden = [decoded(at, k.bit_length() - 1)] if k & (k - 1) == 0 else []
    if k < 64 and len(token.rstrip("=")) % 4 != 1:  # text written in base64 may do without some of its symbols
        hidden.append(decoded([BASE64.find({"-": "+", "_": "/"}.get(c, c)) for c in token.rstrip("=")], 6))
    return -len(at) * math.log(k) - max(text, *(_chance(raw, CASED) for raw in hidden), -math.inf)
