"""Inputs: the driver's tables mapped onto the event and user contracts,
event/alert streams (Kafka or files) and the JDBC user dimension."""
