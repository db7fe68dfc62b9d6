"""Finance reports over ERP tables, written as Spark DataFrame plans."""
