"""webloom: captured web pages to clean text and a link graph, on Spark.

Entry points:

* ``webloom.operators.extract.html_to_markdown`` - pages to Markdown documents
* ``webloom.plans.crawl_job.crawl_site`` - crawl a seed list over captures
* ``webloom.functions.sql_api.register_all`` - the SQL surface (``webloom_*``)
* ``webloom.plans.catalog.QUERIES`` - every registered query
"""

__version__ = "0.1.0"
