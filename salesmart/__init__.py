"""salesmart: order analytics on Spark.

Raw orders, products and access logs are refined into bronze and silver
tables and rolled up into sales marts (product, category, day, hour with
revenue share), page views, order previews and a dashboard document.
Everything is DataFrame / SQL code; every mart is a plain
``DataFrame -> DataFrame`` function with no I/O inside.
"""

__all__ = ["session", "schemas", "sources", "functions", "operators", "plans"]
