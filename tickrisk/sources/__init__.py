"""Sources and sinks: file twins, Kafka + Avro adapters, point writers."""
