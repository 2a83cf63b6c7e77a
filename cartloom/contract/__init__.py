from cartloom.contract.model import Check, Column, Contract, Reference, Table
from cartloom.contract.verify import VerificationError, require

__all__ = ["Check", "Column", "Contract", "Reference", "Table", "VerificationError", "require"]
