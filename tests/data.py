"""Small raw tables of the two systems: the documented line and the edge rows."""

from decimal import Decimal as D

MUSIC = {
    "Artist": [(1, "AC/DC"), (2, "Accept"), (3, "Silent"), (4, "Aerosmith")],
    "Album": [(1, "One", 1), (2, "Two", 2), (3, "Three", 1), (4, "Four", 4)],
    "Customer": [
        (1, " Ana\t", "Silva ", None, "Lisbon", "LX", "Portugal", "1000", "+351", "ana@x.pt", 3),
        (2, None, "Mono", "Mono Ltd", "Oslo", None, "Norway", "0150", None, "m@x.no", None),
        (5, None, None, None, None, None, None, None, None, "none@x", 4),
    ],
    "Employee": [
        (1, "Andrew", "Adams", "General Manager", "Edmonton", "Canada", None),
        (2, "Nancy", "Edwards", "Sales Manager", "Calgary", "Canada", 1),
        (3, "Jane", "Peacock", "Sales Support Agent", "Calgary", "Canada", 2),
        (4, "Margaret", "Park", None, "Calgary", "Canada", 2),
    ],
    "Genre": [(1, "Rock"), (2, None)],
    "Invoice": [
        (100, 1, "2016-07-04", D("2.97")),
        (101, 2, "2010-01-31 00:00:00", D("0.99")),
        (102, 5, "junk", D("1.99")),
        (103, 77, "2010-02-01 00:00:00", D("0.99")),  # no such customer
    ],
    "InvoiceLine": [
        (1, 100, 11, D("0.99"), 1),
        (2, 100, 12, D("0.99"), 2),
        (3, 101, 11, D("0.99"), 1),
        (4, 102, 13, D("1.99"), 1),
        (5, 103, 11, D("0.99"), 1),
        (6, 999, 11, D("0.99"), 1),  # no such invoice
    ],
    "Track": [
        (11, "Rock On", 1, "Angus", D("0.99")),
        (12, "Unnamed Genre", 2, None, D("0.99")),
        (13, "No Genre", None, None, D("1.99")),
    ],
}

FOOD = {
    "Categories": [(1, "Beverages"), (4, "Dairy Products")],
    "Customers": [
        ("VINET", "Vins et alcools", "Paul Henriot", "Reims", "Western Europe", "France", "51100", "26"),
        ("NONAM", "No Name Inc", None, "Bern", None, "Switzerland", None, None),
    ],
    "Employees": [
        (2, "Andrew", "Fuller", "Vice President", "Tacoma", "USA", None),
        (5, "Steven", "Buchanan", "Sales Manager", "London", "UK", 2),
        (6, "\tMichael ", None, None, "London", "UK", 5),
    ],
    "Order Details": [
        (10248, 11, D("14.00"), 12, 0.0),
        (10248, 42, D("9.80"), 10, 0.25),
        (10249, 11, D("10.00"), 3, 0.0),
        (10250, 77, D("1234.50"), 2, 0.5),
        (10251, 11, D("2.00"), 1, 0.0),
        (10252, 42, D("5.00"), 4, 0.0),
        (99999, 11, D("7.00"), 1, 0.0),  # no such order
        (10250, 42, D("3.00"), None, 0.0),  # quantity missing
    ],
    "Orders": [
        (10248, "VINET", 5, "2016-07-04"),
        (10249, None, 6, "2023-08-29 09:23:46"),
        (10250, "NONAM", None, ""),
        (10251, "GHOST", 9, None),
        (10252, "VINET", 5, "2016-10-01 08:00:00"),
    ],
    "Products": [
        (11, "Queso Cabrales", 4, D("21.00")),
        (42, "Singaporean Hokkien", None, None),
    ],
}
