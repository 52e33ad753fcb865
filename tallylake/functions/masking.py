"""Personal-data masks as column expressions. NULL stays NULL in all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the output contract.
TAX_ID_PREFIX = "***.***.**-"


def mask_tax_id(value: Column) -> Column:
    """Keep the last two characters of a tax id."""
    return F.concat(F.lit(TAX_ID_PREFIX), F.right(value, F.lit(2)))


def mask_surname(value: Column) -> Column:
    """Reduce a surname to its initial; an empty surname becomes a lone dot."""
    return F.concat(F.left(value, F.lit(1)), F.lit("."))


def mask_card_number(value: Column) -> Column:
    """Show the last four digits; a number of four digits or fewer is hidden whole."""
    size = F.length(value)
    hidden = F.when(size > 4, size - 4).otherwise(size)
    return F.concat(F.repeat(F.lit("*"), hidden), F.substring(value, hidden + 1, size))


def mask_printed_name(value: Column) -> Column:
    """Reduce every word of a printed name to its initial."""
    return F.regexp_replace(value, r"(\S)\S*", "$1.")


def mask_email(value: Column) -> Column:
    """Keep the first of several mailbox characters and the domain; hide all of anything else.

    Text that is no address, and a mailbox of one character, would otherwise be shown whole.
    """
    shown = F.regexp_replace(value, r"^([^@\s])[^@\s]+@([^@\s]+)$", "$1***@$2")
    hidden = F.regexp_replace(value, r"^[^@\s]@([^@\s]+)$", "***@$1")
    return (
        F.when(value.rlike(r"^[^@\s]{2,}@[^@\s]+$"), shown)
        .when(value.rlike(r"^[^@\s]@[^@\s]+$"), hidden)
        .when(value.isNotNull(), F.lit("***"))
    )


def mask_member(members: DataFrame, tax_id: str = "cpf", surname: str = "sobrenome") -> DataFrame:
    """Apply the two masks every published member row carries."""
    return members.withColumns(
        {tax_id: mask_tax_id(F.col(tax_id)), surname: mask_surname(F.col(surname))}
    )


def mask_strict(df: DataFrame) -> DataFrame:
    """Opt-in policy: also hide card number, printed name and e-mail where present."""
    masks = {
        "num_cartao": mask_card_number,
        "numero_cartao": mask_card_number,
        "nom_impresso": mask_printed_name,
        "nome_impresso_cartao": mask_printed_name,
        "email": mask_email,
    }
    return df.withColumns({c: mask(F.col(c)) for c, mask in masks.items() if c in df.columns})
