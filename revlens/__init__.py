"""revlens: customer and revenue analytics as Spark DataFrame transformations.

Raw e-commerce tables (users, orders, order items, products) become a
layered model -- silver staging tables, a customer dimension with RFM and
lifecycle labels, order and item facts, one order-grain reporting view --
and a set of revenue-leakage and growth reports on top.

Every operator takes DataFrames and returns a lazy DataFrame; nothing is
collected to the driver. The reference date is a parameter so results
repeat.
"""

__version__ = "0.1.0"
