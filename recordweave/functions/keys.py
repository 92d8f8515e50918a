"""Expressions over the 11-digit person key.

They name their input as few times as they can: a predicate on a derived key is
pushed below the projection that derives it, and then repeats that derivation
once per mention.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordweave.functions.text import strip

KEY_DIGITS = 11

# Rejection reasons.
KEY_ABSENT = "cpf_ausente"
KEY_WRONG_LENGTH = "cpf_quantidade_digitos_invalida"
KEY_INVALID = "cpf_invalido"
KEY_BAD_CHECK_DIGITS = "cpf_digito_verificador_invalido"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def key_text(c: Column) -> Column:
    """Key cell as text: trimmed, without a float suffix, missing as empty text."""
    bare = F.regexp_replace(strip(c), r"^(?:nan|<NA>|([0-9]+)\.0+)$", "$1")
    return F.coalesce(bare, F.lit(""))


def normalize_key(c: Column) -> Column:
    """The digits of the key when there are exactly eleven, else NULL."""
    # Digits alone are left, so their number says all; a second pattern would cost as much as the first.
    bare = digits(c)
    return F.when(F.length(bare) == KEY_DIGITS, bare)


def mask_key(c: Column) -> Column:
    """``ddd.ddd.ddd-dd`` for an 11-digit key; other text is returned unchanged."""
    return F.regexp_replace(c, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", r"$1.$2.$3-$4")


def is_usable_key(c: Column) -> Column:
    """True when the text has key length; false (never NULL) otherwise."""
    return F.coalesce(F.length(c) == KEY_DIGITS, F.lit(False))


def rejection_reason(key: Column, shown: Column | None = None) -> Column:
    """NULL for a usable ``key``, otherwise why ``shown`` (default: the key) is unusable."""
    count = F.coalesce(F.length(digits(key if shown is None else shown)), F.lit(0))
    by_count = F.create_map(
        F.lit(0), F.lit(KEY_ABSENT), F.lit(KEY_DIGITS), F.lit(KEY_INVALID)
    )
    why = F.coalesce(F.try_element_at(by_count, count), F.lit(KEY_WRONG_LENGTH))
    return F.when(~is_usable_key(key), why)


def _check_digit(key: Column, count: int) -> Column:
    """Mod-11 digit over the first ``count`` digits, weighted count+1 down to 2."""
    total = reduce(
        add,
        (F.substring(key, i + 1, 1).cast("int") * F.lit(count + 1 - i) for i in range(count)),
    )
    # 11 minus the rest, where rests 0 and 1 both give 0.
    return (F.lit(11) - total % 11) % 11 % 10


def has_valid_check_digits(key: Column) -> Column:
    """Both check digits of a normalised key agree; false for anything else."""
    shaped = key.rlike("^[0-9]{11}$")
    agrees = (_check_digit(key, 9) == F.substring(key, 10, 1).cast("int")) & (
        _check_digit(key, 10) == F.substring(key, 11, 1).cast("int")
    )
    return F.coalesce(F.when(shaped, agrees), F.lit(False))
