"""Writers: delimited text in its variants, JDBC."""
