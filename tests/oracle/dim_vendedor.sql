SELECT DISTINCT codusur AS cod_vendedor, nome AS nm_vendedor FROM pcusuari
