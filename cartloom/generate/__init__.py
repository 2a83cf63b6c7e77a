from cartloom.generate.profile import PROFILES, Profile, profile_named
from cartloom.generate.tables import Generator

__all__ = ["PROFILES", "Generator", "Profile", "profile_named"]
