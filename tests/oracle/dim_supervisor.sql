SELECT codsupervisor AS cod_supervisor, nome AS nm_supervisor FROM pcsuperv
