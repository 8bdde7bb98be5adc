"""ravelin: transcript analytics and corpus preparation on PySpark."""
