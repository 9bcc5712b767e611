"""Analytics over repeated code-generation attempts, as Spark DataFrame operators."""
