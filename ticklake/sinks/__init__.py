"""Writers: snapshot tables, JDBC tables, Kafka messages."""
