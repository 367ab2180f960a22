"""Line-first cleaning and rules on whole documents, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import SPACES, count_of, let, space_word_count, space_words, total
from .words import fresh

SYMBOLS = "#*$%&|<>"
#: A mark that ends a sentence or a clause, with what may close after it, at a line's end; marks between links; and phrases of page furniture (lower case).
ENDS = r"""[.!?:;…。！？]["'”’»)\]]*[\x09-\x0D\x20]*\z"""
LINKS = "|>»•·›"
FURNITURE = (
    "all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "powered by", "privacy policy", "sign in", "skip to content", "subscribe to", "terms of service", "terms of use",
    "alle rechte vorbehalten", "cookie-richtlinie", "datenschutzerklärung", "javascript aktivieren", "newsletter abonnieren", "nutzungsbedingungen", "zum inhalt springen",
    "accepter les cookies", "activer javascript", "aller au contenu", "conditions d'utilisation", "mentions légales", "politique de confidentialité", "tous droits réservés",
    "aceptar cookies", "activar javascript", "aviso legal", "política de privacidad", "saltar al contenido", "términos de uso", "todos los derechos reservados",
)
INDEX_BITS = 24


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words that stands twice or more in the list.

    Windows are sorted as (40 bits of hash, 24 bits of place); places of one hash are compared word by word, and where two windows share
    a hash without being equal, or the list is too long for 24 bits, the windows themselves are sorted."""

    def spread(at: Column) -> Column:
        return total(F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), x + 3) - x).cast("long")))

    def exact(w: Column) -> Column:
        def flagged(pairs: Column) -> Column:
            return F.filter(pairs, lambda p, i: F.coalesce(F.get(pairs, i - 1)["t"] == p["t"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["t"] == p["t"], F.lit(False)))

        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i")))
        return let(F.sort_array(windows), lambda pairs: let(F.sort_array(F.transform(flagged(pairs), lambda p: p["i"])), spread))

    def key(p: Column) -> Column:
        return F.shiftright(p, INDEX_BITS)

    def place(p: Column) -> Column:
        return p.bitwiseAND(F.lit((1 << INDEX_BITS) - 1)).cast("int")

    def hashed(w: Column) -> Column:
        packed = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), INDEX_BITS).bitwiseOR(i.cast("long")))

        def same(p: Column, q: Column) -> Column:
            return F.coalesce(key(p) == key(q), F.lit(False))

        def differ(a: Column, b: Column) -> Column:
            return (F.get(w, a) != F.get(w, b)) | (F.get(w, a + 1) != F.get(w, b + 1)) | (F.get(w, a + 2) != F.get(w, b + 2))

        def count(found: Column) -> Column:
            clash = F.filter(found, lambda p, i: same(p, F.get(found, i - 1)) & differ(place(p), place(F.get(found, i - 1))))
            return F.when(F.size(found) == 0, F.lit(0).cast("long")).when(F.size(clash) > 0, exact(w)).otherwise(let(F.sort_array(F.transform(found, place)), spread))

        return let(F.sort_array(packed), lambda s: let(F.filter(s, lambda p, i: same(p, F.get(s, i - 1)) | same(p, F.get(s, i + 1))), count))

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).when(F.size(words) > (1 << INDEX_BITS), exact(words)).otherwise(hashed(words))


def line_fails(line: Column, n: Column, *, min_words: int, link_share: float, symbol_share: float) -> Column:
    """Punctuation: a short line that doesn't end like a sentence or a clause, or one full of symbols. Navigation: many marks between links. Boilerplate: phrases of page frames in four languages.

    Phrases are a fixed list and not lines that many documents have: those are also the lines of a large group of copies, of which one document has to stay."""
    bare = (n < min_words) & ~line.rlike(ENDS)
    symbols = count_of(line, SYMBOLS) > symbol_share * F.length(line)
    links = count_of(line, LINKS)
    navigation = (links >= 3) & (links > link_share * n)
    furniture = (n <= 40) & let(F.lower(line), lambda low: reduce(lambda a, b: a | b, (low.contains(x) for x in FURNITURE)))
    return bare | symbols | navigation | furniture


def measured(docs: DataFrame, *, text: str = "text", min_words: int = 50, max_repeat: float = 0.5, max_lost: float = 0.5, line_words: int = 5, link_share: float = 0.2, symbol_share: float = 0.1) -> DataFrame:
    """All columns of docs and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_kept_words, clean_text, base_failed, kept.

    Line first: lines of the text are held against punctuation, navigation and furniture rules, and clean_text is the text without those
    that fail; a document is rejected (kept is false) that has fewer than min_words words, more than max_repeat of them in repeated
    windows of three, or loses more than max_lost of its words with its lines. Null text: no words, rejected, clean_text null. Lines
    without a word stay. Texts of any length are gone through whole. Repeated rows each get the same values; no rows give no rows. Columns of docs with the new names give way, others may have any name.
    No shuffle: a row's result comes from the row alone."""
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_kept_words", "clean_text", "base_failed", "kept"]
    own = [c for c in docs.columns if c not in new]
    whole = F.coalesce(docs[text], F.lit(""))
    rules = {"min_words": line_words, "link_share": link_share, "symbol_share": symbol_share}

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        with_word = F.filter(lines, lambda x: x["n"] > 0)
        good = F.filter(lines, lambda x: (x["n"] == 0) | ~line_fails(x["line"], x["n"], **rules))
        return let(
            F.transform(with_word, lambda x: x["line"]),
            lambda full: let(
                good,
                lambda g: F.struct(
                    (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
                    F.size(lines).cast("long").alias("n_lines"),
                    total(F.transform(g, lambda x: x["n"].cast("long"))).alias("n_kept_words"),
                    F.array_join(F.transform(g, lambda x: x["line"]), "\n").alias("clean_text"),
                ),
            ),
        )

    lines = F.transform(F.split(whole, "\n"), lambda x: F.struct(x.alias("line"), space_word_count(x).cast("int").alias("n")))
    (made,) = fresh(docs, "made")
    found = docs.select(*(docs[c] for c in own), F.struct(let(space_words(whole), of_words).alias("w"), let(lines, of_lines).alias("l")).alias(made))
    bad = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(int(round(100 * max_repeat))) * F.col("n_words"))
    return found.select(
        *own, F.col(f"{made}.w.n_words").alias("n_words"), (F.length(F.coalesce(text, F.lit(""))) - count_of(F.coalesce(text, F.lit("")), SPACES)).cast("long").alias("word_chars"),
        count_of(F.coalesce(text, F.lit("")), SYMBOLS).cast("long").alias("n_symbols"), F.col(f"{made}.l.n_dup_lines").alias("n_dup_lines"), F.col(f"{made}.w.n_repeat_words").alias("n_repeat_words"),
        F.col(f"{made}.l.n_lines").alias("n_lines"), F.col(f"{made}.l.n_kept_words").alias("n_kept_words"), F.when(F.col(text).isNotNull(), F.col(f"{made}.l.clean_text")).alias("clean_text"),
    ).select("*", bad.alias("base_failed"), (~bad & (F.col("n_kept_words") >= (1 - max_lost) * F.col("n_words"))).alias("kept"))


def cleaned(docs: DataFrame, *, text: str = "text", **how) -> DataFrame:
    """The documents' own columns without rejected documents (those with null or empty texts among them), failing lines gone from the texts. Columns may have any name.

    Repeated rows stay or go together; no rows give no rows; see measured()."""
    (own,) = fresh(docs, "own")
    others = [c for c in docs.columns if c != text]
    found = measured(docs.select(F.struct(*(docs[c] for c in others)).alias(own) if others else F.lit(None).alias(own), docs[text].alias("text")), **how).where("kept")
    return found.select(*(F.col("clean_text").alias(c) if c == text else F.col(own)[c].alias(c) for c in docs.columns))
