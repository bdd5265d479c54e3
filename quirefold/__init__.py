"""quirefold: document-integrity and page-layout analytics on PySpark."""
