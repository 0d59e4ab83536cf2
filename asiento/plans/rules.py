"""Posting rules as data: which amount goes to which account.

Invoice and payment parameters are two separate number spaces.
"""

from __future__ import annotations

from dataclasses import dataclass

# Document types, currencies, and the company that books the second system.
INVOICE_DOCUMENT = 6
FORM_DOCUMENT = 0
ADVANCE_DOCUMENT = 4
PURGED_DOCUMENT = 5
NOT_RECEIVABLE_DOCUMENTS = (4, 5, 6)
LOCAL_CURRENCY = 1
FOREIGN_CURRENCY = 2
NO_FORM = "-"
EXT_COMPANY = 1
REVERSED = "R"
REPLAY_USER = "SA"
REPLAY_COMPANY = 1


@dataclass(frozen=True)
class InvoiceRule:
    branch: str
    param: int
    amount: str
    lines: str = "all"  # all | without_insurer | with_insurer


# Invoice parameters.
INVOICE_RULES = (
    InvoiceRule("tax", 15, "tax"),
    InvoiceRule("receivable", 1, "total"),
    InvoiceRule("direct_income", 3, "income", "without_insurer"),
    InvoiceRule("insurer_income", 2, "income", "with_insurer"),
    InvoiceRule("insurer_receivable", 14, "insurer_share"),
    InvoiceRule("insurer_premium", 13, "premium"),
    InvoiceRule("discount", 12, "discount_and_financed", "without_insurer"),
    InvoiceRule("insurer_discount", 11, "discount", "with_insurer"),
)
INVOICE_BRANCHES = tuple(rule.branch for rule in INVOICE_RULES)

# Posts for every line, with no parameter and no account where the map has none.
UNMAPPED_BRANCH = "tax"
# Looks its account up by product and insurer.
INSURER_BRANCH = "insurer_receivable"


@dataclass(frozen=True)
class FormRule:
    """What one payment form posts.

    The account comes from the map row with ``param``; from the bank account when
    ``bank`` is set; or it is the constant ``account``. ``requires_map`` tells whether a
    form without its map row posts nothing. ``late_account`` replaces the bank account of
    a late deposit, and names the map row that gives its text.
    """

    branch: str
    form: str
    amount: str
    currency: int | None = LOCAL_CURRENCY
    param: int | None = None
    account: str | None = None
    text: str | None = None
    requires_map: bool = True
    bank: bool = False
    late_account: str | None = None


# Payment parameters, form codes and constant accounts.
RECEIVABLE_PARAM = 1
ADVANCE_PARAM = 8
LATE_PARAM = 14
LATE_ACCOUNT = "2141005"

CARD_AND_DEPOSIT_RULES = (
    FormRule("card_tax", "TRJ", "card_tax", currency=None, param=2),
    FormRule("card_commission", "TRJ", "card_commission", currency=None, param=3),
    FormRule("card_income", "TRJ", "card_net", requires_map=False, bank=True),
    FormRule("deposit", "DPC", "value", bank=True, late_account=LATE_ACCOUNT),
    FormRule("deposit", "CHQ", "value", bank=True, late_account=LATE_ACCOUNT),
)
FORM_RULES = (
    *CARD_AND_DEPOSIT_RULES,
    FormRule(
        "cash_local", "EFE", "value", param=0, account="1111005", text="CTA CTE BANCO BHD",
        requires_map=False,
    ),
    FormRule(
        "cash_foreign", "EFE", "base_value", currency=FOREIGN_CURRENCY, param=12,
        account="1112002",
    ),
    FormRule("credit_note", "NC", "before_tax", param=7),
    FormRule("credit_note_tax", "NC", "tax_part", param=10),
    FormRule("advance_applied", "CRC", "value", param=ADVANCE_PARAM),
    FormRule("withholding_30", "RTC", "value", param=9),
    FormRule("withholding_100", "RT1", "value", param=24),
    FormRule("withholding_5", "R5%", "value", param=13),
    FormRule("write_off", "CCA", "value", param=15),
)
# The second system posts cards and deposits only.
EXT_PREFIX = "ext_"
EXT_FORM_RULES = CARD_AND_DEPOSIT_RULES

# Payment branches, by the company their rows carry: that of the slice, that of the second
# system, or any.
OWN_COMPANY_BRANCHES = (
    *dict.fromkeys(rule.branch for rule in FORM_RULES),
    "advance_received",
)
EXT_BRANCHES = tuple(dict.fromkeys(EXT_PREFIX + rule.branch for rule in EXT_FORM_RULES))
RECEIVABLE_BRANCH = "receivable"
PAYMENT_BRANCHES = (RECEIVABLE_BRANCH, *OWN_COMPANY_BRANCHES, *EXT_BRANCHES)
