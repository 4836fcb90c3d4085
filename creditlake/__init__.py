"""creditlake: consumer-credit lakehouse operators and pipelines on PySpark."""
