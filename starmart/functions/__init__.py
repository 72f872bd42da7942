from starmart.functions.dates import calendar_columns, date_key, parse_date, with_date_key
from starmart.functions.keys import canonical_key, line_key, person_name, strip
from starmart.functions.measures import is_whole, line_amount, money, quantity, surely_fits

__all__ = [
    "calendar_columns",
    "canonical_key",
    "date_key",
    "is_whole",
    "line_amount",
    "line_key",
    "money",
    "parse_date",
    "person_name",
    "quantity",
    "strip",
    "surely_fits",
    "with_date_key",
]
