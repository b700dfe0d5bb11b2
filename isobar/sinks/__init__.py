"""Writers for messages, documents and archives."""
