"""creditspark — credit-loss (IFRS 9) and regulatory-capital (Basel III) analytics on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function usable through
``df.transform(...)``; all loan-grain work is built-in Column expressions.
"""

__version__ = "0.1.0"
