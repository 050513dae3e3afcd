"""Column functions. All of them are built-in Spark expressions; none needs Python workers."""
