"""The same operators over streams of landed records."""
