"""wattline: charging-network analytics as plain Spark DataFrame transforms.

Every operator takes a DataFrame and returns a DataFrame, so jobs are written as
``log.transform(messages, "StopTransaction", 2).transform(unpack_json, STOP_REQUEST)``.
"""
