"""The streaming form of the request job."""
