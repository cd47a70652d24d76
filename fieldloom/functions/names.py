"""First and last names guessed from the text of a first-name field and an email."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldloom.functions.text import initcap_words, none_if_empty


def name_guesses(first: Column, last: Column, email: Column) -> tuple[Column, Column]:
    """(first name guess, last name guess) for one record.

    Three sources: partners written into one field (``mary and john``), a full name
    written into the first-name field (``mary ann``), and the part of an email
    before its ``@`` (``a.b@x.org``).
    """
    # partners
    partners = F.regexp_replace(F.lower(first), " and | & ", ";")
    partner_1 = none_if_empty(initcap_words(F.split_part(partners, F.lit(";"), F.lit(1))))
    partner_2 = none_if_empty(initcap_words(F.split_part(partners, F.lit(";"), F.lit(2))))

    # email
    at = F.locate("@", email)
    mailbox = F.when(at > 0, F.lower(F.left(email, at - 1)))
    mailbox = none_if_empty(F.regexp_replace(mailbox, r"[^a-z._]", ""))
    email_first = none_if_empty(initcap_words(F.regexp_extract(mailbox, r"^[^._]+", 0)))
    email_last = none_if_empty(initcap_words(F.regexp_extract(mailbox, r"[^._]*$", 0)))

    # words of the first-name field; the first keeps its blank
    blank = F.locate(" ", first)
    head = none_if_empty(initcap_words(F.left(first, blank)))
    tail = none_if_empty(initcap_words(F.substr(first, blank + 1)))
    # compared with the raw text, so ``mary`` has a tail (``Mary``) and ``Mary`` has none
    tail = F.when(~tail.eqNullSafe(first), tail)

    first_guess = (
        F.when(partner_2.isNotNull() & partner_1.isNotNull(), partner_1)
        .when(first.isNotNull() & last.isNull() & tail.isNotNull() & head.isNotNull(), head)
        .when(first.isNull() & email_last.isNotNull() & (email_first != email_last), email_first)
        .otherwise(initcap_words(first))
    )
    last_guess = F.when(last.isNull(), F.coalesce(tail, email_last)).otherwise(initcap_words(last))
    return first_guess, last_guess
